"""Texts cut off by field limits or mid-transfer (problem 10).

A stack automaton reads each text once, from its start to its end: brackets, curly and straight
double quotes, code fences and markup elements open and close, and the end is judged by what is
still open and by the last line. Broken multibyte sequences, cut
entities, escapes and tags decide at once; a table row, list item, heading, signature,
link or the like may end without a full stop; running prose may not. Ends that could be
either (a short last line) are held against the corpus: does the same line end stand
elsewhere as an end, or does it only go on (``Childhood`` -> ``Childhood Council``, or
``Childh`` -> ``Childhood``)? All words of all lines are counted for that. Where the corpus says nothing, the source does: in
one whose sound texts hardly ever end without a terminator (``RARE_END``) such an end is a cut. Lengths that pile
up in a source settle ellipses and doubtful ends that have just that length.

Single straight quotes are apostrophes as often and are not on the stack; elements whose end tag may be left
out (``p``, ``li``) neither.

Defined results: null, empty and blank texts are no case; repeated rows of one doc_id
count once; a null source is a source of its own; very long texts are read whole; an empty
table gives an empty table. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hierarq.common import staged

#: A source's length counts as a limit when so many of its unterminated texts have it,
#: and they are this share of the source's unterminated texts.
LIMIT_TEXTS, LIMIT_SHARE = 5, 0.05
#: A line of up to so many code points may be a heading, an item or the like, whose end is an end.
SHORT_LINE = 80
#: A source whose sound texts end without a terminator less often than this has no such ends.
RARE_END = 0.02
#: Size of the filter of asked words, and pairs or words a task holds before it hands them on or forgets them.
FILTER_BITS, FLUSH_AT = 1 << 22, 200_000

# Opening and closing signs, sentence ends, abbreviations that end in a stop.
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "「": "」", "『": "』", "《": "》", "“": "”", "«": "»"}
TERMINATORS = ".!?。！？…؟।։‽"
ABBREVIATIONS = {"e.g.", "i.e.", "etc", "cf.", "vs.", "dr.", "mr.", "mrs.", "ms.", "st.", "no.", "p.", "pp.", "p.ej.", "fig.",
                 "approx.", "sr.", "sra."}

_CLOSERS = "".join(PAIRS.values()) + "\"'’*_`"
# Markup elements that must be closed.
ELEMENTS = frozenset("a abbr article aside b blockquote body button cite code dfn div em figure footer form h1 h2 h3 h4 h5 h6 header html i kbd label main mark "
                     "nav ol pre q s samp section small span strong sub sup table u ul var".split())

_STRUCTURE = re.compile("[" + re.escape("".join([*PAIRS, *PAIRS.values()])) + "\n\"]|```+|~~~+|</?[A-Za-z][^<>]*>")
_CUT_SIGN = re.compile(r"&(?:[A-Za-z][A-Za-z0-9]{0,30}|#x?[0-9A-Fa-f]*)?|\\(?:u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?|%[0-9A-Fa-f]?|<(?:[/!]?[A-Za-z][^<>]*|/)?")
_CLOSING_TAGS = re.compile(r"(?:\s*</[A-Za-z][A-Za-z0-9]*\s*>)+\s*$")
_SEPARATOR = re.compile(r"[\W_]+$")
_ITEM = re.compile(r"\s*(?:([-*•·–])|(\d{1,3}[.)])|(#{1,6}))\s+")
_LINK = re.compile(r"(?:https?://|www\.)\S+$|\S+@\S+\.\w+$")
_TAGS = re.compile(r"(?:[#@]\w+\s*)+$")
_FIELD = re.compile(r"[^\s:：][^:：.!?]{0,40}[:：]\s*\S.{0,60}$|.{1,40}\s\d+$")
_CJK = re.compile("[぀-ヿ㐀-䶿一-鿿가-힯]")
_WORD = re.compile(r"[^\W\d_]+")
_LINES = re.compile(r"\r\n|\n|\r")
_DANGLING = re.compile(r"(?:\S+ )?(?:[A-Z]\.|\d+\.)$")
_STOP = re.compile(r"[.!?。！？…]\s")


def broken_end(text: str) -> bool:
    """Whether a text without blanks at its end stops inside a multibyte sequence, an entity, an escape or a tag."""
    if text.endswith("\ufffd"):
        return True
    at = max(text.rfind(c) for c in "&\\%<")
    if at < 0 or not _CUT_SIGN.fullmatch(text, at):
        return False
    return len(text) > at + 1 or text[at] in "\\<" or at > 0 and not text[at - 1].isspace() and not (text[at] == "%" and text[at - 1].isdigit())


def open_signs(text: str) -> list[str]:
    """What the automaton still holds at the end: signs, quotes and elements of the last paragraph's, and fences and
    elements from before. A bracket or quote is forgotten at a blank line: it was left open by
    its author, not by a cut. Nothing counts inside a fence but its end."""
    signs: list[str] = []
    blocks: list[str] = []
    fence = ""
    last = -2
    for m in _STRUCTURE.finditer(text):
        c = m.group()
        if c[0] in "`~" and len(c) >= 3:
            if not text[text.rfind("\n", 0, m.start()) + 1 : m.start()].strip():
                fence = "" if fence and c[0] == fence[0] and len(c) >= len(fence) else fence or c
            continue
        if fence:
            continue
        if c == "\n":
            if m.start() == last + 1 or text[last + 1 : m.start()].isspace():
                signs.clear()
            last = m.start()
        elif c in PAIRS:
            signs.append(c)
        elif c == '"':
            before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
            if c in signs:
                del signs[len(signs) - 1 - signs[::-1].index(c) :]
            elif after.strip() and (not before.strip() or before in PAIRS or before in "—–-"):
                signs.append(c)
        elif c[0] == "<":
            name = re.match(r"</?([A-Za-z][A-Za-z0-9]*)", c).group(1).lower()
            if name not in ELEMENTS or c.endswith("/>"):
                continue
            if c[1] != "/":
                blocks.append(name)
            elif name in blocks:
                del blocks[len(blocks) - 1 - blocks[::-1].index(name) :]
        elif signs and PAIRS.get(signs[-1]) == c:
            signs.pop()
    return ([fence] if fence else []) + blocks + signs


def _core(line: str) -> str:
    """The line without closing signs, symbols and blanks at its end."""
    end = len(line)
    while end and (line[end - 1].isspace() or line[end - 1] in _CLOSERS or ord(line[end - 1]) >= 0x1F000
                   or line[end - 1] in "\u200d\ufe0f" or 0x2600 <= ord(line[end - 1]) <= 0x27BF):
        end -= 1
    return line[:end]


_NUMBER = re.compile("[0-9]+")


def line_kind(line: str) -> str:
    """The start mark under which the words of a line are counted: list items only compare with
    list items, signatures with signatures, other lines with each other."""
    m = _ITEM.match(line)
    return "-" if m and m.group(1) else "1" if m and m.group(2) else "#" if m else "^"


def end_words(line: str) -> tuple[str, str]:
    """(kind and last word but one, last word), with # for numbers."""
    kind, words = line_kind(line), _NUMBER.sub("#", line).split()
    return kind + (words[-2] if len(words) > 1 else ""), words[-1]


def judge(text: str) -> tuple[str, str]:
    """(verdict, reason): ``cut``, ``whole``, ``ellipsis`` or ``ask`` (the corpus)."""
    t = text.rstrip()
    if not t:
        return "whole", "blank"
    if broken_end(t):
        return "cut", "broken sequence"
    stack = open_signs(t)
    t = _CLOSING_TAGS.sub("", t) or t
    lines = _LINES.split(t)
    line = lines[-1].strip()
    if line.startswith("|"):
        rows = [x.strip() for x in lines if x.strip().startswith("|")]
        most = Counter(x.count("|") for x in rows[:-1]).most_common(1)
        whole = line.endswith("|") and len(line) > 1 and (not most or line.count("|") >= most[0][0])
        return ("whole", "table row") if whole else ("cut", "table row")
    if re.search(r"(?:\.\.\.|…)$", t):
        return "ellipsis", "open sign" if stack else "ellipsis"
    if _SEPARATOR.fullmatch(line) and not re.search(r"[,;:，、；：]$", line) and not stack:
        return "whole", "separator"
    core = _core(line)
    closed = core and core[-1] in TERMINATORS
    if closed:
        last = core.split()[-1]
        if last.lower() in ABBREVIATIONS or last.lower().lstrip("(“\"'") in ABBREVIATIONS:
            return "cut", "abbreviation"
        tail = _STOP.split(core)[-1]
        if core == line and (_DANGLING.fullmatch(tail) or re.fullmatch(r"\d{1,3}[.)]", line)):
            return "cut", "number or code"
        return ("cut", "open sign") if stack and core == line else ("whole", "terminated")
    if stack:
        return "cut", "open sign"
    if _LINK.search(line) and " " not in line or _TAGS.fullmatch(line):
        return ("whole", "tag") if _TAGS.fullmatch(line) else ("ask", "link")
    if re.search(r"[,;:，、；：(]$", line):
        return "cut", "comma"
    item = _ITEM.match(line)
    if item:
        kind = next(i for i in (1, 2, 3) if item.group(i))
        peers = [x.strip() for x in lines[:-1] if (m := _ITEM.match(x)) and m.group(kind)]
        ended = sum(bool(_core(x)) and _core(x)[-1] in TERMINATORS for x in peers)
        if peers and ended * 2 > len(peers) or not peers and kind == 2:
            return "cut", "list item"
        return "ask", "list item"
    if _STOP.search(line):
        return "cut", "prose"
    if len(line) > SHORT_LINE or len(lines) == 1 and len(line.split()) > 3:
        return "cut", "prose"
    if _CJK.search(line):
        return ("cut", "prose") if len(line) > 12 or "，" in line else ("ask", "short line")
    words = _WORD.findall(line)
    small = [w for w in words if w[0].islower() and len(w) > 3]
    if not re.match(r"[—–-]", line) and not _FIELD.fullmatch(line) and (
            len(small) * 2 >= len(words) > 2 or len(small) * 3 >= len(words) > 4):
        return "cut", "prose"
    return "ask", "short line"


_ENDS_SCHEMA = ("doc_id long, source string, n_chars int, n_bytes int, verdict string, reason string, ended boolean, w1 string, "
                "w2 string")


def ends(docs: DataFrame) -> DataFrame:
    """The verdict on each text by itself, and the last two words where it is ``ask``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, source, text in zip(frame.doc_id, frame.source, frame.text, strict=True):
                verdict, reason = judge(text)
                w1 = w2 = None
                if verdict == "ask":
                    w1, w2 = end_words(_LINES.split(text.rstrip())[-1].strip())
                ended = reason == "terminated"
                rows.append((doc, source, len(text), len(text.encode("utf-8", "replace")), verdict, reason, ended, w1, w2))
            yield pd.DataFrame(rows, columns=["doc_id", "source", "n_chars", "n_bytes", "verdict", "reason", "ended", "w1", "w2"])

    kept = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND trim(text) <> ''").select("doc_id", "source", "text")
    return kept.mapInPandas(run, _ENDS_SCHEMA)


def line_ends(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(w1, w2, stops, goes_on): how often a word pair ends a short line of the corpus that has
    no terminator, and how often more follows, over all words of all lines of all texts, for the
    first words w1 of ``asked``. Of a long line it is not known whether its end is one.

    A filter of ``FILTER_BITS`` bits, whatever is asked, tells the tasks which words may be asked, so pairs are
    counted before the shuffle and only those of asked words travel; what it lets through in error is joined off."""
    spark = docs.sparkSession
    marks = asked.select(F.pmod(F.crc32(F.encode("w1", "UTF-8")), F.lit(FILTER_BITS)).cast("int").alias("b")).distinct().toPandas().b.to_numpy()
    table = np.zeros(FILTER_BITS, dtype=bool)
    table[marks] = True
    sent = spark.sparkContext.broadcast(np.packbits(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(sent.value).view(bool)
        known: dict[str, dict[str, bool]] = {k: {} for k in "-1#^"}
        stops: Counter = Counter()
        goes: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(stops.keys() | goes.keys())
            cols = (pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                    pa.array([stops[k] for k in keys], pa.int64()), pa.array([goes[k] for k in keys], pa.int64()))
            stops.clear()
            goes.clear()
            return pa.RecordBatch.from_arrays(list(cols), names=["w1", "w2", "stops", "goes_on"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for raw in _LINES.split(text):
                    line = raw.strip()
                    if not line or line[0] == "|":
                        continue
                    kind, short = line_kind(line), len(line) <= SHORT_LINE
                    memo = known[kind]
                    words = _NUMBER.sub("#", line).split()
                    before = ""
                    last = words.pop()
                    for w in words:
                        hit = memo.get(before)
                        if hit is None:
                            if len(memo) > FLUSH_AT:
                                memo.clear()
                            hit = memo[before] = bool(bits[zlib.crc32((kind + before).encode("utf-8", "replace")) % FILTER_BITS])
                        if hit:
                            goes[kind + before, w] += 1
                        before = w
                    if short and bits[zlib.crc32((kind + before).encode("utf-8", "replace")) % FILTER_BITS]:
                        (goes if last[-1] in TERMINATORS else stops)[kind + before, last] += 1
                if len(goes) + len(stops) > FLUSH_AT:
                    yield flush()
        yield flush()

    texts = docs.where("text IS NOT NULL AND trim(text) <> ''").select("text")
    parts = texts.mapInArrow(run, "w1 string, w2 string, stops long, goes_on long")
    return parts.groupBy("w1", "w2").agg(F.sum("stops").alias("stops"), F.sum("goes_on").alias("goes_on")).join(
        asked.select("w1").distinct(), "w1", "left_semi")


def source_limits(ended: DataFrame) -> DataFrame:
    """(source, measure, size): lengths in code points or bytes at which the unterminated
    texts of a source pile up. Byte limits are found up to three bytes below, where a
    multibyte character did not fit."""
    open_ended = ended.where("verdict IN ('cut', 'ellipsis')")
    sized = open_ended.select("source", F.explode(F.array(
        F.struct(F.lit("chars").alias("measure"), F.col("n_chars").alias("size")),
        F.struct(F.lit("bytes").alias("measure"), (4 * F.ceil(F.col("n_bytes") / 4)).cast("int").alias("size"),
                 ))).alias("m")).select("source", "m.measure", "m.size")
    counts = sized.groupBy("source", "measure", "size").count()
    totals = counts.groupBy(F.col("source").alias("_s"), F.col("measure").alias("_m")).agg(F.sum("count").alias("n"))
    return counts.join(totals, F.col("source").eqNullSafe(F.col("_s")) & (F.col("measure") == F.col("_m"))).where(
        (F.col("count") >= LIMIT_TEXTS) & (F.col("count") >= LIMIT_SHARE * F.col("n"))).select(
        "source", "measure", "size", F.col("count").alias("texts"))


def source_baselines(ended: DataFrame) -> DataFrame:
    """(source, unended): the share of a source's texts that are not cut by themselves and yet end without a terminator."""
    sound = ended.where("verdict <> 'cut'")
    return sound.groupBy("source").agg(F.avg((~F.col("ended")).cast("double")).alias("unended"))


def _of_source(rows: DataFrame, per: DataFrame) -> DataFrame:
    """``rows`` with what is known per source; sources are few beside their texts, null is one of them."""
    p = per.withColumnRenamed("source", "_source")
    return rows.join(p, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_chars, n_bytes, cut boolean, reason), one row per doc_id. ``reason`` says what decided."""
    own = staged(ends(docs), "text-ends")  # read several times below, texts once
    asked = own.where("verdict = 'ask'").select("w1", "w2").distinct()
    counts = staged(line_ends(docs, asked), "line-ends")
    exact = asked.join(counts, ["w1", "w2"], "left").select(
        "w1", "w2", F.coalesce("stops", F.lit(0)).alias("stops"), F.coalesce("goes_on", F.lit(0)).alias("goes_on"))
    # Words of which the last word may be the beginning: of every word that followed w1 the beginnings as long as
    # an asked one, per distinct pair and not per occurrence.
    sizes = asked.groupBy("w1").agg(F.collect_set(F.length("w2")).alias("sizes"))
    parts = counts.join(sizes, "w1").select("w1", "w2", (F.col("stops") + F.col("goes_on")).alias("longer"), F.explode(
        F.filter("sizes", lambda n: n < F.length("w2"))).alias("size")).select(
        "w1", F.substring("w2", F.lit(1), F.col("size")).alias("w2"), "longer")
    longer = parts.join(asked, ["w1", "w2"], "left_semi").groupBy("w1", "w2").agg(F.sum("longer").alias("longer"))
    evidence = exact.join(longer, ["w1", "w2"], "left").select(
        "w1", "w2", (F.col("stops") - 1).alias("others"),
        (F.col("goes_on") + F.coalesce("longer", F.lit(0))).alias("more"))
    limits = source_limits(own)
    open_ends = own.where("verdict IN ('ellipsis', 'ask')").select("doc_id", "source", "n_chars", "n_bytes", "verdict", "reason", "w1", "w2")
    at_limit = open_ends.join(limits.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")) & (
        ((F.col("measure") == "chars") & (F.col("size") == F.col("n_chars")))
        | ((F.col("measure") == "bytes") & (F.col("size") - F.col("n_bytes")).between(0, 3)))).select("doc_id").distinct().withColumn("_limit", F.lit(True))
    known = _of_source(open_ends.join(at_limit, "doc_id", "left").join(evidence, ["w1", "w2"], "left"), source_baselines(own))
    more, others = F.coalesce("more", F.lit(0)), F.coalesce("others", F.lit(0))
    # A length proves nothing against an end that stands elsewhere as an end.
    limited = F.coalesce("_limit", F.lit(False)) & ((F.col("verdict") == "ellipsis") | (others <= 0))
    nothing = (more == 0) & (others <= 0)
    why = F.when(limited, "length limit").when(F.col("verdict") == "ellipsis", F.when(F.col("reason") == "open sign", "open sign")).when(
        more > others, "goes on elsewhere").when(nothing & (F.col("unended") < RARE_END), "source ends otherwise")
    decided = known.select("doc_id", "source", "n_chars", "n_bytes", why.isNotNull().alias("cut"), F.coalesce(why, "reason").alias("reason"))
    plain = own.where("verdict IN ('cut', 'whole')").select(
        "doc_id", "source", "n_chars", "n_bytes", (F.col("verdict") == "cut").alias("cut"), "reason")
    every = plain.unionByName(decided)
    return every.groupBy("doc_id").agg(F.max(F.struct("cut", "source", "n_chars", "n_bytes", "reason")).alias("_r")).select(
        "doc_id", "_r.source", "_r.n_chars", "_r.n_bytes", "_r.cut", "_r.reason")


def truncated(docs: DataFrame) -> DataFrame:
    """(doc_id) of the texts that stop before their own end."""
    return judged(docs).where("cut").select("doc_id")


def truncation_reasons(docs: DataFrame) -> DataFrame:
    """How many of the cut texts of a source what decided."""
    return judged(docs).where("cut").groupBy("source", "reason").agg(F.count("*").alias("texts"))


def truncation_shares(docs: DataFrame) -> DataFrame:
    """Per source: texts, cut texts and their share."""
    return judged(docs).groupBy("source").agg(
        F.count("*").alias("texts"), F.count_if("cut").alias("cut_texts"),
        F.round(F.avg(F.col("cut").cast("double")), 6).alias("cut_share"))
