"""Noise in text from scanned pages (problem 2): words broken across lines, misread
characters, running headers and printed page numbers are found, and repaired.

Words. All texts are counted into a word table. Each word that holds odd characters, or is
rare beside others, looks up correction candidates by an inverted join on the character
q-grams of its skeleton (a spelling in which characters that scanners confuse are equal). Both
sides of the join carry their rarest q-grams, so many that two skeletons within ``SKELETON_EDITS`` edits share one (prefix
filter): none of these pairs is lost. Gradient-boosted trees, fitted on corrupted
copies of all the corpus's own words, choose among the candidates. What is found are words; texts
that hold them are found by joining their tokens, after the at most ``TRUSTED_WORDS`` most
frequent sound words are dropped on the spot by a broadcast set.

Furniture. Boosted trees on the shape of a line and on what the corpus says of it decide on page
numbers and headers. They are taught by the documents: printed numbers of a document keep one
distance to its pages, headers come again on other pages of theirs.

Line joins. A line end with a hyphen sign is paired with the line that goes on, with furniture
between them passed over; in LINE blocks by an equi-join on positions. Boosted trees decide
whether a pair is one word, and whether it keeps its hyphen. They are taught by the corpus's
unbroken lines: its words cut in two, its compounds, its suspended hyphens (``two- and``) and
number ranges; their features are how often the parts and the whole stand in it.

All trees are fitted on all rows that teach them, by the distinct bins of their features with their counts.

Defined results: null and empty texts have no noise; copies of a row count once; a text of
one line has its own line end only in LINE blocks; table cells (CELL) print no headers,
page numbers or line ends; ties between candidates go to the more frequent, then to the
alphabetically first; blocks without a page number are repaired one by one; empty tables give
empty tables; texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hierarq.common import salted_join, staged
from hierarq.llm.boost import BoostedTrees, in_bins
from hierarq.operators.ordered import following

#: Words kept in the broadcast set of sound words; the others meet the found words by a join.
TRUSTED_WORDS = 20_000
#: The weight of a pair that stands often: it is taught as if it stood so many times at most.
COPIES = 50
#: A word seen once proves no spelling; one without odd characters is looked up when a
#: candidate is so many times as frequent.
MIN_REFERENCE, RARE_RATIO = 2, 8
#: Edits between two skeletons that the q-gram join finds without loss: so many from the given lengths of the
#: shorter one on. A skeleton of that length has more q-grams than so many edits can spoil.
Q, SKELETON_EDITS = 3, {4: 1, 7: 2}
#: A document says where its pages' numbers are when so many lines agree.
OFFSET_LINES = 3
FLUSH_AT = 300_000
#: Pieces between blanks that a task remembers as free of words to be looked at.
SOUND_PIECES = 100_000
#: Separates the parts of a pair.
MARK, AHEAD, WITHIN = "\x1f", "\x1e", "\x1d"

# Hyphen signs, and the characters that scanners take for each other.
ODD = "€§|!0123456789"
CONFUSIONS = [
    ("e", "€"), ("o", "0"), ("l", "1"), ("i", "l"), ("i", "|"), ("i", "!"), ("i", "1"), ("l", "|"), ("s", "5"), ("s", "§"),
    ("g", "9"), ("b", "6"), ("b", "8"), ("z", "2"), ("m", "rn"), ("rn", "m"), ("e", "c"), ("c", "e"), ("h", "b"), ("h", "li"),
    ("u", "n"), ("n", "u"), ("w", "vv"), ("cl", "d"), ("d", "cl"), ("l", "i"), ("m", "nn"), ("b", "h"), ("rt", "tt"), ("q", "9"),
    ("a", "4"), ("a", "@"), ("s", "$"), ("t", "7"),
]
ROMAN = "(?=[ivxl])(?:l|xl|x{0,3})(?:ix|iv|v?i{0,3})"

_SIGNS = "\\-\u2010\u2011\u2012\u2013\u2212\u00ac\u00ad\u2043\ufe63\uff0d"
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u02af\u0300-\u1fff\u2c00-\u2dff\u3040-\ud7ff\uf900-\ufdff"
_LATIN = "A-Za-z0-9\u00c0-\u024f\u0300-\u036f\u1e00-\u1eff€§"
_NEW_LINE = r"[ \t\u00a0]*(?:\r\n|\n|\r)[ \t\u00a0]*"
_JOIN = re.compile(f"[{_SIGNS}](?:(?<=[{_LETTER}€§|!].)|(?<=[{_LETTER}][0-9].)){_NEW_LINE}")
TOKEN = re.compile(f"[!|]?[{_LATIN}]+(?:[|!@$][{_LATIN}]+)*\\|?")
_NO_WORD = re.compile(r"[A-Z]{1,4}\d+$|[\d|!]+[A-Z]{0,2}$|.{1,2}$")
_NUMBER_BEFORE = re.compile(r"^\s*(?:\d{1,4}|" + ROMAN + r")(?:\s{2,}|\s*[|·•]\s*)(?=\S)")
_NUMBER_AFTER = re.compile(r"(?<=\S)(?:\s{3,}|\s*\|\s*)(?:\d{1,4}|" + ROMAN + r")\s*$")
_PIECE = f"[{_LATIN}|!@$]+"
_END = re.compile(f"({_PIECE})([{_SIGNS}])[ \t\u00a0\r\n]*$")
_FIRST_SHAPE = f"^[ \t\u00a0\r\n]*({_PIECE})"
_FIRST = re.compile(_FIRST_SHAPE)
_MID = re.compile(f"[{_SIGNS}]([ \t\u00a0]*)(?=({_PIECE}))")
_IN_PIECE = frozenset(re.findall(_PIECE[:-1], "".join(map(chr, range(0x2100)))))
_DIGITS = re.compile(r"\d+")
_ALONE = re.compile(r"(?<![^\W_])\d+(?![^\W_])")
_IS_ROMAN = re.compile(ROMAN + "$")
_HEADING = re.compile(r"\S+ \S*\d\S*\s*:|.*[^\W\d_)”][.?!] ")
_LINE_BREAK = re.compile(r"\r\n|\n|\r")
_CUT_ODD = re.compile(f"[a-z]{{2}}[€§|!0-9][{_SIGNS}]\\s*$")
STRONG_ODD = "[a-zà-ÿ](?:[€§|!]|[0-9])[a-zà-ÿ]|[a-zà-ÿ]{2}[€§|]|[€§|][a-zà-ÿ]{2}"

# Spellings made equal: first parts of letters, then characters.
_PARTS = [("rt", "tt"), ("nn", "rn"), ("m", "rn"), ("w", "vv"), ("d", "ei"), ("h", "ii"), ("b", "ii"), ("6", "ii"), ("8", "ii")]
_SAME, _AS = "0l1|!€c5§$9qu2@47", "oiiiieesssggnzaat"
_SAME_PAIRS = [*_PARTS, *zip(_SAME, _AS, strict=True)]  # no character stands on both sides, so one after the other is as good as all at once


def line_key(line: str) -> str:
    """``skeleton`` of a line, with single blanks."""
    t = " ".join(line.lower().split())
    for a, b in _SAME_PAIRS:
        t = t.replace(a, b)
    return t


#: A word cut by these signs never keeps them: they mark a place, they are no hyphens.
_SOFT = frozenset("\u00ac\u00ad")
_SIGN_SET = frozenset("-\u2010\u2011\u2012\u2013\u2212\u00ac\u00ad\u2043\ufe63\uff0d")
_TITLE_ENDS = _SIGN_SET | frozenset(".?!,;:…。？！，)”\"")


def _lines(text: str) -> list[str]:
    return _LINE_BREAK.split(text) if "\r" in text else text.split("\n")


def _has_hyphen(lines: list[str]) -> bool:
    """Whether one of the lines of a text ends with a hyphen sign."""
    return any([x.rstrip()[-1:] in _SIGN_SET for x in lines])


def _closed(text: str) -> str:
    """The text with lines joined at hyphens, without a word that is open at its end."""
    if not _has_hyphen(_lines(text)):
        return text
    return _joined(text)


def _joined(text: str) -> str:
    """``_closed`` for a text that has a hyphen at the end of a line."""
    text = _JOIN.sub("", text).rstrip()
    return text[: max(text.rfind(" "), text.rfind("\n")) + 1] if text[-1:] in _SIGN_SET else text


def _piece_before(text: str, end: int) -> str:
    """The part of a word that stops at ``end``."""
    start = end
    while start and text[start - 1] in _IN_PIECE:
        start -= 1
    return text[start:end]


def skeleton(c: Column) -> Column:
    """Lower case with characters that scanners confuse made equal."""
    c = F.lower(c)
    for a, b in _PARTS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, _SAME, _AS)


def units(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(table_name, row_id, doc, kind, page, pos, text) of both tables."""
    a = blocks.select(F.lit("text_blocks").alias("table_name"), F.col("block_id").alias("row_id"),
                      F.col("document_s3_key").alias("doc"), F.col("block_type").alias("kind"),
                      F.col("page_number").alias("page"), "pos", "text")
    b = elements.select(F.lit("detected_elements").alias("table_name"), F.col("element_id").alias("row_id"),
                        F.col("document_s3_key").alias("doc"), F.lit("ELEMENT").alias("kind"),
                        F.col("source_page").alias("page"), F.lit(None).cast("long").alias("pos"),
                        F.col("source_text").alias("text"))
    return a.unionByName(b).where("row_id IS NOT NULL AND text IS NOT NULL AND text <> ''")


# --- words ------------------------------------------------------------------------------


def word_counts(u: DataFrame) -> DataFrame:
    """(kind, word, n) over all texts, counted per task before the shuffle: ``word``, words in lower case, those
    broken at a line end joined first and the open word at the end of a LINE left out; and within
    lines ``compound``, the parts beside a hyphen, and ``suspended``, the words beside a hyphen and a
    blank, both as their skeletons with a MARK between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()  # of what stands between blanks: no word reaches over one
        pairs: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words: Counter = Counter()
            for piece, n in counts.items():
                for w in TOKEN.findall(piece):
                    if not _NO_WORD.match(w):
                        words[w.lower()] += n
            rows = [("word", w, n) for w, n in words.items()]
            keys: Counter = Counter()
            for (kind, left, right), n in pairs.items():
                keys[kind, f"{line_key(left)}{MARK}{line_key(right)}"] += n
            rows += [(*k, n) for k, n in keys.items()]
            counts.clear()
            pairs.clear()
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)],
                                              names=["kind", "word", "n"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for text in texts:
                counts.update(_closed(text).split())
            text = "\n".join(texts)  # no pair reaches over a line break
            for m in _MID.finditer(text):
                left = _piece_before(text, m.start())
                if left and not left.isdigit():
                    pairs["suspended" if m.group(1) else "compound", left, m.group(2)] += 1
            if len(counts) + len(pairs) > FLUSH_AT:
                yield flush()
        yield flush()

    return u.select("text").mapInArrow(run, "kind string, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))


def _edit(a: str, b: str) -> tuple[int, int]:
    """(plain edits, edits left after the known confusions) that turn a into its misreading b."""
    n, m = len(a), len(b)
    big = n + m
    plain = [[0] * (m + 1) for _ in range(n + 1)]
    left = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if i == 0 and j == 0:
                continue
            p = q = big
            if i:
                p, q = plain[i - 1][j] + 1, left[i - 1][j] + 1
            if j:
                p, q = min(p, plain[i][j - 1] + 1), min(q, left[i][j - 1] + 1)
            if i and j:
                d = a[i - 1] != b[j - 1]
                p, q = min(p, plain[i - 1][j - 1] + d), min(q, left[i - 1][j - 1] + d)
            for x, y in _BY_END.get(a[i - 1] if i else "", ()):
                if b.endswith(y, 0, j) and a.endswith(x, 0, i):
                    q = min(q, left[i - len(x)][j - len(y)])
                    p = min(p, plain[i - len(x)][j - len(y)] + 1)
            plain[i][j], left[i][j] = p, q
    return plain[n][m], left[n][m]


_BY_END: dict[str, list[tuple[str, str]]] = {}
for _x, _y in CONFUSIONS:
    _BY_END.setdefault(_x[-1], []).append((_x, _y))


def pair_features(word: str, count: int, reference: str, reference_count: int) -> list[float]:
    plain, left = _edit(reference, word)
    odd = sum(c in ODD for c in word)
    return [plain, left, plain / max(1, len(reference)), odd, len(reference), np.log1p(count),
            np.log1p(reference_count) - np.log1p(count), float(word[:1] == reference[:1]),
            float(len(word) - len(reference))]


def _lessons(word: str, n: int, other: str | None) -> Iterator[tuple[bool, list[float]]]:
    """(is a misreading, features) of corrupted copies of a word (most by known confusions, some by any odd character in the
    word) and of pairs with different sound words, some of them made rare. Deterministic in the word."""
    rng = np.random.default_rng(zlib.crc32(word.encode()))
    ways = [(x, y) for x, y in CONFUSIONS if x in word]
    bad = []
    for size in (1, 1, 2, 3):
        w = word
        for _ in range(size):
            if ways:
                x, y = ways[rng.integers(len(ways))]
                at = [i for i in range(len(w)) if w.startswith(x, i)]
                if at:
                    i = at[rng.integers(len(at))]
                    w = w[:i] + y + w[i + len(x) :]
        bad.append(w)
    if len(word) > 5:
        i = int(rng.integers(1, len(word) - 1))
        bad.append(word[:i] + ODD[rng.integers(len(ODD))] + word[i + 1 :])
    for w in bad:
        if w != word:
            yield True, pair_features(w, max(1, int(n * rng.choice([0.001, 0.01, 0.04]))), word, n)
    near = [w for w in (word + "s", word[:-1], word[1:], word[:2] + word[3:], "un" + word, word + "ed", word[:-1] + word[-2:-1], word[:1] + "a" + word[2:],
                        word[:-2] + "ly") if len(w) > 2]
    for w in [other or word, *near]:
        if w != word:
            yield False, pair_features(w, max(1, int(n * rng.choice([0.001, 0.01, 0.3, 1.0]))), word, n)


#: Rounds of the trees that choose among candidates.
RANKER_ROUNDS = 60


def fit_ranker(words: list[tuple[str, int]]) -> BoostedTrees:
    """Boosted trees that tell misreadings (class 1) from other words (class 0), taught by all ``words``."""
    rows = [x for (w, n), (other, _) in zip(words, words[1:] + words[:1], strict=True) for x in _lessons(w, n, other)]
    return BoostedTrees(rounds=RANKER_ROUNDS).fit(np.array([f for _, f in rows], dtype=float).reshape(len(rows), -1), np.array([x for x, _ in rows], dtype=float))


def _ranker(words: DataFrame) -> BoostedTrees:
    """``fit_ranker`` on the rows of ``words`` (word, n); another word is the one after it by hash."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [x for w, n, other in zip(f.word, f.n, f.other, strict=True) for x in _lessons(w, n, other)]
            yield pd.DataFrame(rows, columns=["bad", "x"])

    paired = following(words.select("word", "n"), [], [F.xxhash64("word"), F.col("word")], ["word"]).select("word", "n", F.col("next.word").alias("other"))
    paired = paired.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")  # few bytes, much work
    return _taught(paired.mapInPandas(run, "bad boolean, x array<double>"), "bad", "x", BoostedTrees(rounds=RANKER_ROUNDS))


def _grams(c: str) -> Column:
    padded = F.concat(F.lit("^"), F.col(c), F.lit("$"))
    at = F.sequence(F.lit(1), F.length(padded) - (Q - 1))
    return F.array_distinct(F.transform(at, lambda i: F.substring(padded, i, F.lit(Q))))


def _edits(size: Column) -> Column:
    """Edits allowed to a skeleton of a size."""
    allowed: Column = F.lit(0)
    for least, edits in sorted(SKELETON_EDITS.items()):
        allowed = F.when(size >= least, edits).otherwise(allowed)
    return allowed


def candidate_pairs(doubtful: DataFrame, reference: DataFrame) -> DataFrame:
    """(skel, r_skel) of skeletons of ``doubtful`` and ``reference`` (skel) within ``SKELETON_EDITS`` edits.

    Prefix filter: an edit spoils at most Q grams, so of the Q * edits + 1 rarest grams of a skeleton
    at least one stands in the other; by one order of the grams for both sides it is among the
    rarest of the other too. Grams that no reference has come first in that order."""
    ref = reference.select("skel").distinct().select("skel", F.explode(_grams("skel")).alias("gram"))
    df = staged(ref.groupBy("gram").agg(F.count("*").alias("df")), "scan-grams")

    def rarest(words: DataFrame, counts: DataFrame | None) -> DataFrame:
        g = words.select("skel", F.explode(_grams("skel")).alias("gram"))
        g = salted_join(g, df, ["gram"], F.col("skel"), "left", counts=counts)
        g = g.groupBy("skel").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram"))).alias("g"))
        return g.select("skel", F.explode(F.slice("g", F.lit(1), Q * _edits(F.length("skel")) + 1)).alias("g")).select("skel", F.col("g.gram").alias("gram"))

    index = rarest(reference.select("skel").distinct(), df.select("gram", F.col("df").alias("n"))).withColumnRenamed("skel", "r_skel")
    probes = rarest(doubtful.select("skel").distinct(), None)
    least = _edits(F.least(F.length("skel"), F.length("r_skel")))
    near = probes.join(index, "gram").where(F.abs(F.length("skel") - F.length("r_skel")) <= least).select("skel", "r_skel").distinct()
    return near.where(F.levenshtein("skel", "r_skel") <= least)


def corrections(counts: DataFrame) -> DataFrame:
    """(word, replacement, score) of the words that are misreadings.

    ``counts`` (word, n) should be staged: it is read several times. ``replacement`` is null
    for words whose characters give them away but for which the corpus has no candidate."""
    letters = F.col("word").rlike("^[\\p{L}\\p{M}]+$")
    bare = counts.withColumn("odd", ~letters).withColumn("skel", skeleton(F.col("word"))).where(F.length("skel") >= 3)
    reference = bare.where(~F.col("odd") & (F.col("n") >= MIN_REFERENCE))
    # A word without odd characters is in doubt only if some word is so many times as frequent.
    top = reference.agg(F.max("n")).first()[0] or 0
    doubtful = bare.where(F.col("odd") | (F.col("n") * RARE_RATIO <= top))
    pairs = candidate_pairs(doubtful, reference)
    r = reference.select(F.col("skel").alias("r_skel"), F.col("word").alias("r"), F.col("n").alias("r_n"))
    near = pairs.join(doubtful, "skel").join(r, "r_skel").where(
        (F.col("word") != F.col("r")) & (F.col("odd") | (F.col("r_n") >= F.col("n") * RARE_RATIO)))
    model = _ranker(reference.where("length(word) >= 3"))

    def rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.array([pair_features(w, n, r, m) for w, n, r, m in zip(f.word, f.n, f.r, f.r_n, strict=True)])
                f = f.assign(score=model.predict(x))
                yield f[f.score >= 0.5][["word", "odd", "r", "r_n", "score"]]

    ranked = near.select("word", "n", "odd", "r", "r_n").mapInPandas(
        rank, "word string, odd boolean, r string, r_n long, score double")
    best = ranked.groupBy("word").agg(F.max_by(F.struct("r", "score"), F.struct(
        F.col("r_n"), F.round("score", 6), F.reverse("r"))).alias("b")).select(
        "word", F.col("b.r").alias("replacement"), F.col("b.score").alias("score"))
    odd = bare.where(F.col("odd") & F.col("word").rlike(STRONG_ODD)).select("word")
    return best.unionByName(odd.join(best, "word", "left_anti").select(
        "word", F.lit(None).cast("string").alias("replacement"), F.lit(0.5).alias("score")))


# --- lines ------------------------------------------------------------------------------

SIGNS_SCHEMA = "table_name string, row_id long, doc string, kind string, page int, pos long, sign string, value string, f array<float>"


def _title(line: str) -> tuple[str, bool, list[float]] | None:
    """(core, numbered, shape) of a line that may be a header: of two words at least, not in lower case; prose too, since it
    teaches what no header is, and a header may read like it. ``core`` is the line without a page number beside it."""
    core = line.strip()
    if not 6 <= len(core) <= 130 or core[0].islower() and core[0] not in "ivxl":
        return None
    whole = len(core)
    if core[0] in "0123456789ivxl":
        core = _NUMBER_BEFORE.sub("", core)
    if core[-1] in "0123456789ivxl":
        core = _NUMBER_AFTER.sub("", core)
    if not 6 <= len(core) <= 120 or " " not in core or core[0].islower():
        return None
    parts = core.split()
    ascii_only = core.isascii()
    coded = core.encode() if ascii_only else b""
    digits = len(coded) - len(coded.translate(None, b"0123456789")) if ascii_only else sum(map(str.isdigit, core))
    words = len(parts) - sum([w.isdigit() for w in parts]) if digits else len(parts)
    if words < 2:
        return None
    longer = [w for w in parts if len(w) > 3]
    small = sum([w[0].islower() for w in longer])
    count = core.count
    return core, len(core) < whole - 1, [
        words, len(longer), small, small / max(1, len(longer)), len(core), digits, count("|") if ascii_only else count("—") + count("–") + count("·") + count("|"),
        core[-1] in _TITLE_ENDS, count(". ") + count("! ") + count("? "), count(":"), count(","), core.isupper(),
        core[0].isalpha(), digits > 0 and any(map(str.isdigit, "".join(parts[:2])))]


def _roman(text: str) -> int:
    values = [{"i": 1, "v": 5, "x": 10, "l": 50}[c] for c in text]
    return sum(-v if any(w > v for w in values[i + 1 :]) else v for i, v in enumerate(values))


def _number_line(line: str) -> tuple[str, list[float]] | None:
    """(pattern, [number, shape...]) of a line that may be a printed page number: short, with a number or a Roman
    one. The pattern is the line with # for numbers."""
    t = line.strip() if len(line) <= 60 else ""
    if not t or len(t) > 30:
        return None
    alone = _ALONE.search(t)
    m = alone or _DIGITS.search(t)
    roman = not m and _IS_ROMAN.match(t.lower())
    if not m and not roman or m and len(m.group()) > 4:
        return None
    letters = sum(c.isalpha() for c in t)
    shape = [len(t), letters, len(_DIGITS.findall(t)), len(t.split()), t[0] in "[(" and t[-1] in "])", not t[0].isalnum() and t[0] == t[-1], t[-1] in ".!?:;,",
             roman is not None and not m, t[0].isdigit(), t[-1].isdigit()]
    return "roman" if not m else line_key((_ALONE if alone else _DIGITS).sub("#", t)), [int(m.group()) if m else _roman(t.lower()), *shape]


def _ahead(lines: list[str], i: int) -> str:
    """The lines that may go on from line i - 1 of a text, up to the first that can be no furniture: for each its first part
    of a word, and the keys by which it may be furniture."""
    out = []
    for line in lines[i:]:
        first, number, title = _FIRST.match(line), _number_line(line), _title(line) if len(line) <= 130 else None
        out.append(WITHIN.join((first.group(1) if first else "", f"number {number[0]}" if number else "", f"title {line_key(title[0])}" if title else "")))
        if not number and not title:
            break
    return AHEAD.join(out)


def line_signs(u: DataFrame, trusted: frozenset[str]) -> DataFrame:
    """What stands in each text, one row per sign: ``pair`` (the part of a word and the sign at a line end with a hyphen, and what
    is ahead in the text), ``end`` (the same at the end of a text), ``number`` (a line that may be a page number: its pattern), ``title`` (one that may be a header; ``titlen`` with a number
    beside it), ``word`` and ``lead`` (words that are not ``trusted``; a LINE's first), ``odd`` (a misread
    part of a word at the end of a LINE). ``f`` are the features of number and title."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sound: set[str] = set()
        for batch in batches:
            out: list[tuple] = []  # (row in the batch, sign, value), and of some the features
            features, sizes = array("f"), array("i")
            for at, kind, text in zip(range(batch.num_rows), batch.column(3).to_pylist(), batch.column(6).to_pylist(), strict=True):
                whole = text
                if kind != "CELL":
                    lines = _lines(text)
                    hyphen = _has_hyphen(lines)
                    if kind == "LINE":
                        lines = [text]
                        if hyphen and _CUT_ODD.search(text):
                            out.append((at, "odd", None))
                    if hyphen:
                        full = [x for x in lines if x.strip()]
                        for i, line in enumerate(full):
                            m = _END.search(line) if line.rstrip()[-1:] in _SIGN_SET else None
                            if m and not m.group(1).isdigit():  # a number is no part of a word
                                ahead = _ahead(full, i + 1)
                                out.append((at, "pair" if ahead else "end", MARK.join((m.group(1), m.group(2), *([ahead] if ahead else [])))))
                    for line in lines:
                        if len(line) > 130:
                            continue
                        number = _number_line(line)
                        if number:
                            sizes.extend([*[0] * (len(out) - len(sizes)), len(number[1])])
                            features.extend(number[1])
                            out.append((at, "number", number[0]))
                        t = _title(line)
                        if t:
                            sizes.extend([*[0] * (len(out) - len(sizes)), len(t[2])])
                            features.extend(t[2])
                            out.append((at, "titlen" if t[1] else "title", line_key(t[0])))
                    if hyphen:
                        text = _joined(text)
                pieces = set(text.split())
                pieces -= sound
                if pieces:
                    words = set()
                    for piece in pieces:
                        told = [w for w in TOKEN.findall(piece.lower()) if w not in trusted and not _NO_WORD.match(w)]
                        words.update(told)
                        if not told:
                            sound.add(piece)
                    if len(sound) > SOUND_PIECES:
                        sound.clear()
                    if words:
                        m = TOKEN.search(whole.lower()) if kind == "LINE" and whole.lstrip()[:1].islower() else None
                        lead = m.group() if m else None
                        out += [(at, "lead" if w == lead else "word", w) for w in words]
            rows, signs, values = zip(*out, strict=True) if out else ((), (), ())
            rows = pa.array(rows, pa.int32())
            sizes.extend([0] * (len(out) - len(sizes)))
            n = np.array(sizes, dtype=np.int32)
            f = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.array(features, dtype=np.float32)), mask=pa.array(n == 0))
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(rows).cast(types[i]) for i in range(6)], pa.array(signs, pa.string()), pa.array(values, pa.string()), f], names=fields)

    fields = [x.split()[0] for x in SIGNS_SCHEMA.split(", ")]
    kinds_of = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<float>": pa.list_(pa.float32())}
    types = [kinds_of[x.split()[1]] for x in SIGNS_SCHEMA.split(", ")]
    return u.select("table_name", "row_id", "doc", "kind", F.col("page").cast("int"), "pos", "text").mapInArrow(
        run, SIGNS_SCHEMA)


def _matrix(lists: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix, without a Python object per value."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def _taught(rows: DataFrame, label: str, features: str, model: BoostedTrees | None = None, weight: str | None = None) -> BoostedTrees:
    """Trees (``model``) fitted on all ``rows``, which stand ``weight`` times each.

    The tasks count the rows per label and features, cut the features at their exact quantiles and count again per bins;
    the driver fits on the distinct bins with their counts."""
    model = model or BoostedTrees()
    counted = staged(rows.groupBy(F.col(label).alias("y"), F.col(features).alias("x")).agg(F.sum(F.col(weight) if weight else F.lit(1)).alias("n")), "scan-lessons")
    any_row = counted.select(F.size("x")).first()
    if any_row is None:
        return model.fit(np.zeros((0, 1)), np.zeros(0))
    cuts = F.array(*[F.lit(float(c)) for c in model.cuts])
    got = counted.agg(*[F.percentile(F.col("x")[i].cast("double"), cuts, F.col("n")).alias(f"e{i}") for i in range(any_row[0])]).first()
    edges = [np.unique(np.array(e)) for e in got]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bins = pa.array([r.tobytes() for r in in_bins(_matrix(b.column(1)), edges)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), bins, b.column(2)], names=["y", "b", "n"])

    binned = counted.mapInArrow(run, "y boolean, b binary, n long").groupBy("y", "b").agg(F.sum("n").alias("n")).toPandas()
    binned["b"] = binned.b.map(bytes)
    binned = binned.sort_values(["b", "y"])  # sums of floats depend on the order
    bins = np.frombuffer(b"".join(binned.b), dtype=np.uint8).reshape(len(binned), len(edges))
    return model.fit_binned(bins, edges, binned.y.to_numpy(dtype=float), binned.n.to_numpy(dtype=float))


def _scored(rows: DataFrame, model: BoostedTrees, features: str, name: str = "score") -> DataFrame:
    """``rows`` with the probability the trees give to ``features``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                score = pa.array(model.predict(_matrix(b.column(b.schema.get_field_index(features)))), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns, score], names=[*b.schema.names, name])

    return rows.mapInArrow(run, f"{fields}, {name} double")


def headers(signs: DataFrame) -> DataFrame:
    """The lines that are running headers: (doc, value).

    Lines that come again on another page of their document teach what a header looks like. A line
    that comes again must look so, one that stands once must look so without doubt."""
    known = signs.where("sign IN ('title', 'titlen')").groupBy("doc", "value").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.min("f").alias("f")).select(
        "doc", "value", "f", F.coalesce(F.col("low") < F.col("high"), F.lit(False)).alias("recurs"))
    lines = staged(known, "scan-titles")
    scored = _scored(lines, _taught(lines, "recurs", "f"), "f")
    return scored.where(F.col("score") >= F.when(F.col("recurs"), 0.5).otherwise(0.9)).select("doc", "value")


def page_numbers(signs: DataFrame) -> DataFrame:
    """(table_name, row_id, value) of the texts in which a printed page number stands, with its pattern.

    In a document printed numbers keep one distance to the page they stand on. The distance that most lines
    agree on labels the lines of documents with ``OFFSET_LINES`` of them; trees on the shape of a line
    and on how its pattern agrees everywhere decide on all."""
    own = signs.where("sign = 'number'").select("table_name", "row_id", "doc", "value", "f", (F.col("f")[0].cast("int") - F.col("page")).alias("off"))
    offs = own.where("off IS NOT NULL AND doc IS NOT NULL").groupBy("doc", "off").agg(F.countDistinct("row_id").alias("n"))
    best = offs.groupBy("doc").agg(F.max_by(F.struct("off", "n"), F.struct("n", -F.abs("off"))).alias("b")).select(
        "doc", F.col("b.off").alias("usual"), F.col("b.n").alias("lines"))
    rows = salted_join(own, best, ["doc"], F.struct("row_id", "value"), "left")
    rows = staged(rows.withColumns({"known": F.coalesce(F.col("lines") >= OFFSET_LINES, F.lit(False)), "agrees": F.coalesce(F.col("off") == F.col("usual"), F.lit(False))}),
                  "scan-numbers")
    told = rows.where("known").groupBy("value").agg(F.count("*").alias("n"), F.count_if("agrees").alias("a"), F.countDistinct("doc").alias("docs"))
    every = salted_join(rows, told, ["value"], F.col("row_id"), "left")
    # What the pattern does elsewhere: a line is not told by itself.
    n, a = F.coalesce("n", F.lit(0)) - F.col("known").cast("int"), F.coalesce("a", F.lit(0)) - (F.col("known") & F.col("agrees")).cast("int")
    more = F.array((a + 0.5) / (n + 1), F.log1p(n), F.log1p(F.coalesce("docs", F.lit(0))))
    x = F.transform(F.concat(F.slice("f", 2, F.size("f") - 1).cast("array<double>"), more), lambda v: v.cast("float"))
    every = every.select("table_name", "row_id", "value", "known", "agrees", x.alias("x"))
    every = staged(every, "scan-number-shapes")
    model = _taught(every.where("known"), "agrees", "x")
    return _scored(every, model, "x").where("score >= 0.5").select("table_name", "row_id", "value").distinct()


# --- line joins -------------------------------------------------------------------------


def line_pairs(signs: DataFrame, furniture: DataFrame, u: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table_name, row_id, left, hyphen, right) of every line end with a hyphen, right null where nothing goes on;
    and (doc, pos) of the LINE blocks that go on. Lines that are ``furniture`` are passed over."""
    by_row = ["table_name", "row_id"]
    keys = furniture.groupBy(*by_row).agg(F.collect_set(F.concat(F.when(F.col("sign") == "number", "number ").otherwise("title "), "value")).alias("keys"))
    open_ends = signs.where("sign = 'end' AND kind <> 'LINE'").select(*by_row, "value")
    part = F.split("value", MARK)
    chains = signs.where("sign = 'pair'").select(*by_row, "value").join(keys, by_row, "left")
    chain = F.transform(F.split(part[2], AHEAD), lambda x: F.split(x, WITHIN))
    none = F.array().cast("array<string>")
    going = F.filter(chain, lambda x: ~F.arrays_overlap(F.filter(F.slice(x, 2, 2), lambda k: k != ""), F.coalesce("keys", none)))
    first = F.try_element_at(F.try_element_at(going, F.lit(1)), F.lit(1))
    inside = chains.select(*by_row, F.concat_ws(MARK, part[0], part[1], first).alias("value")).unionByName(open_ends)
    furniture = furniture.where("table_name = 'text_blocks'").select("row_id").distinct()
    own = u.where("kind = 'LINE' AND doc IS NOT NULL").select("row_id", "doc", "pos", F.regexp_extract("text", _FIRST_SHAPE, 1).alias("value"))
    text = own.distinct().join(furniture, "row_id", "left_anti")
    after = following(text, ["doc"], [F.col("pos"), F.col("row_id")], ["pos", "value"]).select("row_id", "doc", F.col("next.pos").alias("next_pos"), F.col("next.value").alias("first"))
    ended = signs.where("sign = 'end' AND kind = 'LINE'").groupBy("row_id").agg(F.max("value").alias("tail")).join(furniture, "row_id", "left_anti")
    met = ended.join(after, "row_id", "left")
    met = staged(met.select("row_id", "doc", "next_pos", F.when(F.col("first").isNull(), F.col("tail")).otherwise(F.concat_ws(MARK, "tail", "first")).alias("value")), "scan-ends")
    every = inside.unionByName(met.select(F.lit("text_blocks").alias("table_name"), "row_id", "value")).distinct()
    return (every.select("table_name", "row_id", part[0].alias("left"), part[1].alias("hyphen"), F.try_element_at(part, F.lit(3)).alias("right")),
            met.where("next_pos IS NOT NULL").select("doc", F.col("next_pos").alias("pos")).distinct())


def _asked_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (left, right) with their skeletons and the keys under which the corpus is asked about them."""
    r = F.coalesce("right", F.lit(""))
    p = pairs.withColumns({"l": skeleton(F.col("left")), "r": skeleton(r)})
    keys = [F.concat(F.lit("word" + MARK), x) for x in (skeleton(F.concat("left", r)), F.col("l"), F.col("r"))]
    keys += [F.concat(F.lit("compound" + MARK), F.col("l"), F.lit(MARK), F.col("r")), F.concat(F.lit("left" + MARK), F.col("l")), F.concat(F.lit("right" + MARK), F.col("r"))]
    return p.withColumn("keys", F.array(*keys))


def _evidence(counts: DataFrame) -> DataFrame:
    """(key, n): how often words stand in the corpus, compounds, and words at both sides of suspended hyphens."""
    two = F.split("word", MARK)
    named = counts.where("kind = 'word'").select(F.concat(F.lit("word" + MARK), skeleton(F.col("word"))).alias("key"), "n")
    joined = counts.where("kind = 'compound'").select(F.concat(F.lit("compound" + MARK), "word").alias("key"), "n")
    apart = counts.where("kind = 'suspended'")
    sides = [apart.select(F.concat(F.lit(name + MARK), two[i]).alias("key"), "n") for i, name in enumerate(("left", "right"))]
    return named.unionByName(joined).unionByName(sides[0]).unionByName(sides[1]).groupBy("key").agg(F.sum("n").alias("n"))


def pair_decisions(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """(left, right, broken, keeps) of distinct ``pairs`` (left, right): whether a word is broken there, and whether it
    keeps its hyphen when joined.

    Two models, taught by unbroken lines: all words cut in two, compounds and suspended hyphens of the corpus,
    those that stand often with a weight of up to ``COPIES``. In every other copy what is
    known of the whole is hidden, as if it stood nowhere else; some have nothing after them."""
    asked = pairs.select("left", "right").distinct().select("left", "right", F.lit("").alias("label"), F.lit(False).alias("hidden"), F.lit(1).cast("long").alias("w"))
    h = F.xxhash64("word")
    at = (2 + F.pmod(h, F.greatest(F.length("word") - 3, F.lit(1)))).cast("int")
    letters = F.col("word").rlike("^\\p{L}{6,}$")
    words = counts.where((F.col("kind") == "word") & letters & (F.col("n") > MIN_REFERENCE)).select(
        F.substring("word", F.lit(1), at).alias("left"), F.substring("word", at + 1, F.length("word")).alias("right"), F.lit("word").alias("label"), "n")
    two = F.split("word", MARK)
    beside = counts.where("kind <> 'word'").select("kind", "word", "n", two[0].alias("left"), two[1].alias("right"))
    kinds = [("compound", "kind = 'compound' AND length(left) > 1"), ("apart", "kind = 'suspended'")]
    taught = [words] + [beside.where(c).select("left", "right", F.lit(x).alias("label"), "n") for x, c in kinds]
    copies = F.sequence(F.lit(0), F.when(F.col("label") == "word", 1).otherwise(F.least("n", F.lit(COPIES)).cast("int") - 1))
    copied = reduce(DataFrame.unionByName, taught).select("left", "right", "label", F.explode(copies).alias("copy"))
    turn = F.when(F.col("label") == "word", F.pmod(F.xxhash64("left"), F.lit(5))).otherwise(F.col("copy") % 5)
    alone = F.when(turn != 4, F.col("right"))
    lessons = copied.groupBy("left", alone.alias("right"), "label", (F.col("copy") % 2 == 1).alias("hidden")).agg(F.count("*").alias("w"))
    rows = asked.unionByName(lessons).withColumn("id", F.xxhash64("left", "right", "label", "hidden"))
    own = ["left", "right", "label", "hidden", "w", "l", "r"]
    probes = _asked_pairs(rows).select("id", F.struct(*own).alias("own"), F.posexplode("keys").alias("slot", "key"))
    told = salted_join(probes, _evidence(counts), ["key"], F.struct("id", "slot"), "left").groupBy("id").agg(
        F.any_value("own").alias("own"), *[F.max(F.when(F.col("slot") == i, F.log1p("n"))).alias(f"e{i}") for i in range(6)]).select("own.*", *[f"e{i}" for i in range(6)])
    slot = F.when(F.col("label") == "word", 0).when(F.col("label") == "compound", 3).otherwise(4)
    x = F.array(*[F.when(F.col("hidden") & (slot == i), 0.0).otherwise(F.coalesce(f"e{i}", F.lit(0.0))) for i in range(6)],
                F.length("l"), F.length("r"), F.col("right").isNull().cast("int"))
    full = staged(told.select("left", "right", "label", "w", F.transform(x, lambda v: v.cast("float")).alias("x")), "scan-joins")
    lessons = full.where("label <> ''").select("x", "w", (F.col("label") != "apart").alias("whole"), (F.col("label") == "compound").alias("compound"))
    broken = _taught(lessons, "whole", "x", weight="w")
    keeps = _taught(lessons.where("whole"), "compound", "x", weight="w")
    got = _scored(_scored(full.where("label = ''"), broken, "x", "b"), keeps, "x", "k")
    return got.select("left", "right", (F.col("b") >= 0.5).alias("broken"), (F.col("k") >= 0.5).alias("keeps"))


def joins(signs: DataFrame, furniture: DataFrame, counts: DataFrame, u: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table_name, row_id, left, hyphen, right, broken, keeps) of every line end with a hyphen, and (doc, pos) of the LINE blocks
    that go on."""
    pairs, going_on = line_pairs(signs, furniture, u)
    pairs = staged(pairs, "scan-line-pairs")
    means = pair_decisions(pairs, counts)
    key = F.concat_ws(MARK, F.col("left"), F.coalesce("right", F.lit(MARK)))
    told = means.select(key.alias("pair"), "broken", "keeps")
    return salted_join(pairs.withColumn("pair", key), told, ["pair"], F.col("row_id")).drop("pair"), going_on


def analysed(blocks: DataFrame, elements: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The staged signs of all texts, the staged (word, replacement, score), and the staged counts."""
    u = units(blocks, elements)
    counts = staged(word_counts(u), "scan-words", by="kind")
    words = counts.where("kind = 'word'").drop("kind")
    found = staged(corrections(words), "scan-corrections")
    trusted = words.join(found, "word", "left_anti").orderBy(F.desc("n"), "word").limit(TRUSTED_WORDS)
    sound = frozenset(r.word for r in trusted.collect())  # at most TRUSTED_WORDS words
    return staged(line_signs(u, sound), "scan-signs", by="sign"), found, counts


def furniture_of(signs: DataFrame) -> DataFrame:
    """(table_name, row_id, sign, value) of the lines that are furniture: ``number`` with its pattern, ``title`` and
    ``titlen`` with their key. Staged."""
    with ThreadPoolExecutor(2) as pool:  # their jobs do not need each other
        titles, numbers = pool.submit(headers, signs), pool.submit(page_numbers, signs)
        head = signs.where("sign IN ('title', 'titlen')").join(titles.result(), ["doc", "value"], "left_semi").select("table_name", "row_id", "sign", "value")
        return staged(head.unionByName(numbers.result().withColumn("sign", F.lit("number")).select(head.columns)), "scan-furniture")


def noise(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(table_name, row_id, noise), one row per text and kind of noise in it."""
    signs, found, counts = analysed(blocks, elements)
    furniture = furniture_of(signs)
    pairs, going_on = joins(signs, furniture, counts, units(blocks, elements))
    bad = signs.where("sign IN ('word', 'lead')").withColumnRenamed("value", "word").join(found.select("word"), "word")
    # The first piece of a LINE may be the rest of a word: plain letters prove nothing there.
    rest = (F.col("sign") == "lead") & F.col("word").rlike("^[\\p{L}\\p{M}]+$")
    bad = bad.where(~rest).select("table_name", "row_id").unionByName(
        bad.where(rest).join(going_on, ["doc", "pos"], "left_anti").select("table_name", "row_id")).unionByName(
        signs.where("sign = 'odd'").select("table_name", "row_id"))
    kind = F.when(F.col("sign") == "number", F.array(F.lit("page_number"))).when(
        F.col("sign") == "titlen", F.array(F.lit("header"), F.lit("page_number"))).otherwise(F.array(F.lit("header")))
    lines = furniture.select("table_name", "row_id", F.explode(kind).alias("noise"))
    cut = pairs.where("broken").select("table_name", "row_id", F.lit("hyphen").alias("noise"))
    return lines.unionByName(bad.withColumn("noise", F.lit("misread"))).unionByName(cut).distinct()


# --- repair -----------------------------------------------------------------------------


def _repair_page(texts: list[tuple[str, str, frozenset[str], frozenset[str], dict[str, str]]], means: dict[tuple[str, str], tuple[bool, bool]]) -> list[str]:
    """Paragraphs of one page or element from (kind, text, header keys, number patterns, replacements) in
    reading order: furniture lines go, words broken at line ends are joined as ``means`` (left, right) -> (broken,
    keeps its hyphen) says, misread words are replaced; a paragraph ends at a line that ends a sentence well before the usual
    width, at a heading, and at a table cell, which stands by itself."""
    lines: list[tuple[str, str, bool]] = []  # (line as printed, line, is cell)
    for kind, text, head, numbers, fixes in texts:
        for line in [text] if kind == "CELL" else _LINE_BREAK.split(text):
            if kind != "CELL":
                number = _number_line(line) if numbers else None
                t = _title(line) if head and len(line) <= 130 else None
                if number and number[0] in numbers or t and line_key(t[0]) in head:
                    continue
            sound = TOKEN.sub(lambda m, f=fixes: _with_case(m.group(), f.get(m.group().lower())), line) if fixes else line
            if sound.strip():
                lines.append((line.strip(), sound.strip(), kind == "CELL"))
    width = max([len(x) for _, x, cell in lines if not cell], default=0)
    out: list[str] = []
    open_end, before = False, ""
    for raw, line, cell in lines:
        if open_end and not cell:
            last, end, first = out[-1], _END.search(before), _FIRST.match(raw)
            if end and last[-1] in _SIGN_SET:
                number = end.group(1).isdigit()  # a range of numbers closes up
                broken, keeps = (True, True) if number else means.get((end.group(1), first.group(1) if first else ""), (True, False))
                out[-1] = f"{last} {line}" if not broken else (last if keeps and last[-1] not in _SOFT else last[:-1]) + line
            else:
                out[-1] = f"{last} {line}"
        else:
            out.append(line)
        before = raw
        ended = line[-1] in ".!?。！？:”)" and len(line) < 0.8 * width
        open_end = not cell and not ended and not _HEADING.fullmatch(line) and not re.fullmatch(r"\S+ \S*\d\S*\s*:.*", line)
    return out


def _with_case(word: str, fixed: str | None) -> str:
    if not fixed:
        return word
    if word.isupper():
        return fixed.upper()
    return fixed[:1].upper() + fixed[1:] if word[:1].isupper() else fixed


def paragraphs(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """(table_name, document, page, row_id, paragraph_no, text): the repaired text of each
    page of text_blocks (row_id null) and of each element, continuous and readable. Blocks without a
    page number stand for themselves, with their row_id.

    The groups that are collected are single pages and single elements."""
    signs, found, counts = analysed(blocks, elements)
    furniture = furniture_of(signs)
    pairs, _ = joins(signs, furniture, counts, units(blocks, elements))
    by_row = ["table_name", "row_id"]
    heads = furniture.groupBy(*by_row).agg(F.collect_set(F.when(F.col("sign") != "number", F.col("value"))).alias("heads"),
                                           F.collect_set(F.when(F.col("sign") == "number", F.col("value"))).alias("numbers"))
    fixes = signs.where("sign IN ('word', 'lead')").withColumnRenamed("value", "word").join(
        found.where("replacement IS NOT NULL"), "word").groupBy(*by_row).agg(
        F.map_from_entries(F.collect_set(F.struct("word", "replacement"))).alias("fixes"))
    means = pairs.where("right IS NOT NULL").groupBy(*by_row).agg(F.collect_set(F.struct("left", "right", "broken", "keeps")).alias("means"))
    u = units(blocks, elements).groupBy(*by_row).agg(F.max(F.struct("doc", "kind", "page", "pos", "text")).alias("r"))
    rows = u.select(*by_row, "r.*").join(heads, by_row, "left").join(fixes, by_row, "left").join(means, by_row, "left")
    alone = F.when((F.col("table_name") == "text_blocks") & F.col("page").isNotNull(), F.lit(None).cast("long")).otherwise(F.col("row_id"))
    grouped = rows.groupBy("table_name", "doc", "page", alone.alias("element")).agg(F.collect_list(F.struct(
        F.coalesce("pos", F.lit(0)).alias("pos"), F.col("row_id"), "kind", "text", "heads", "numbers", "fixes", "means")).alias("parts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = lambda x: x if x is not None else ()
        for f in frames:
            out = []
            for name, doc, pg, element, parts in zip(f.table_name, f.doc, f.page, f.element, f.parts, strict=True):
                ordered = sorted(parts, key=lambda x: (x["pos"], x["row_id"]))
                texts = [(x["kind"], x["text"], frozenset(some(x["heads"])), frozenset(some(x["numbers"])), dict(x["fixes"] or {})) for x in ordered]
                known = {(m["left"], m["right"]): (m["broken"], m["keeps"]) for x in ordered for m in some(x["means"])}
                out += [(name, doc, pg, element, i, t) for i, t in enumerate(_repair_page(texts, known))]
            yield pd.DataFrame(out, columns=["table_name", "document", "page", "row_id", "paragraph_no", "text"]).astype(
                {"page": "Int32", "row_id": "Int64"})

    return grouped.mapInPandas(run, "table_name string, document string, page int, row_id long, paragraph_no int, text string")
