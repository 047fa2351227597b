"""Mapping free-entered values to a canonical list (problem 7).

Entries and typed values are first written in one form (``age_forms`` for age bands:
number words, fractions, units and languages become ``low-high m``), then a BK-tree over
the entries' forms under the Levenshtein metric returns every entry within the threshold,
pruned by the triangle inequality. Digits never count as typing errors: a form whose
digits differ from the entry's is no match, whatever the distance.

What a value asks of the list (``asked``), what a tree answers (``answered``) and what is made of
the answers (``decided``) are three steps. A list of at most ``MAX_BROADCAST`` forms is one
tree. A longer list is dealt over shards of about ``SHARD_FORMS`` forms; every shard answers for
the distinct values, and only the answers of all shards together are decided on, so the
result does not depend on how the list is cut.

Defined results: null and blank values are no case; a value that means no entry maps to
0; ties between entries at equal distance go to the smaller id; repeated rows of one id
count once (a conflict between copies goes to the smaller distance, then to the smaller
band_id above 0); an empty reference list maps everything to 0; long values are searched whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hierarq.common import salted_join, staged
from hierarq.llm.number_words import TENS, WORDS, chinese, vietnamese

MAX_BROADCAST = 100_000
SHARD_FORMS = 50_000


def levenshtein(a: str, b: str, limit: int | None = None) -> int:
    """Edit distance; with ``limit`` any result above it may be returned as limit + 1."""
    if a == b:
        return 0
    if limit is not None and abs(len(a) - len(b)) > limit:
        return limit + 1
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (x != y))
        if limit is not None and min(row) > limit:
            return limit + 1
    return row[-1]


class BKTree:
    """Burkhard-Keller tree; a node's children are keyed by their distance to it."""

    def __init__(self, items: list[tuple[str, int]] = ()) -> None:
        self.root: list | None = None
        for form, entry in items:
            self.add(form, entry)

    def add(self, form: str, entry: int) -> None:
        if self.root is None:
            self.root = [form, {entry}, {}]
            return
        node = self.root
        while True:
            d = levenshtein(form, node[0])
            if d == 0:
                node[1].add(entry)
                return
            if d not in node[2]:
                node[2][d] = [form, {entry}, {}]
                return
            node = node[2][d]

    def within(self, form: str, threshold: int) -> list[tuple[int, int, str]]:
        """Every (distance, entry, form) within the threshold, best first."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            d = levenshtein(form, node[0])
            if d <= threshold:
                found += [(d, entry, node[0]) for entry in node[1]]
            stack += [child for edge, child in node[2].items() if d - threshold <= edge <= d + threshold]
        return sorted(found)


# Units and words around ages.
MONTH_WORDS = ["m", "mo", "mos", "mth", "mths", "month", "months", "mes", "meses"]
YEAR_WORDS = ["y", "yo", "y/o", "yr", "yrs", "year", "years", "ano", "anos", "age", "ages", "aged", "edad", "edades"]
OTHER_UNITS = ["week", "weeks", "wk", "wks", "day", "days", "hour", "hours", "semana", "semanas", "dia", "dias", "hora",
               "horas", "grade", "grades", "grado", "grados", "page", "pagina"]
RANGE_WORDS = ["to", "through", "thru", "until", "till", "a", "al", "hasta", "-"]
FILLER_WORDS = ["old", "olds", "of", "from", "de", "desde", "between", "the", "los", "las", "edad"]
BY_WORDS = ["by", "hacia", "al", "los"]
#: A word of so many letters may be a number word with one typing error.
NUMBER_LETTERS = 5

_TOKEN = re.compile(r"\d+(?:\.\d+)?|y/o|[^\W\d_]+|-|/|[^\s\w]")
_NUMBER = re.compile(r"\d+(?:\.\d+)?$")
_NUMBER_TREE = BKTree([(w, n) for w, n in (WORDS | TENS).items() if len(w) >= NUMBER_LETTERS])
_UNIT_TREE = BKTree([(w, i) for i, w in enumerate(w for w in MONTH_WORDS + YEAR_WORDS if len(w) >= 5)])


def plain(text: str) -> str:
    """Lower case without accents, fractions as ``+1/2``, one kind of dash, single blanks."""
    t = text.replace("½", " 1/2 ").replace("⁄", "/")
    t = unicodedata.normalize("NFKD", t.replace("\u00a0", " ").lower())
    t = chinese("".join(c for c in t if not unicodedata.combining(c)))
    t = re.sub(r"[‐-―−~]", "-", t)
    t = re.sub(r"\b(\d+)\s+(\d)\s*/\s*(\d+)(?!\d)", lambda m: str(float(Fraction(int(m[2]), int(m[3]) or 1) + int(m[1]))), t)
    t = re.sub(r"(?<=[a-z])\.(?=[a-z0-9])", "", t)  # p.k.3
    return re.sub(r"\s+", " ", t).strip(" \t\n.,;:()[]{}*\"'")


def _tokens(text: str) -> list[str]:
    return vietnamese(_TOKEN.findall(plain(text)))


def _corrected(tokens: list[str]) -> list[str]:
    """Words one typing error away from a single number word become that word."""
    out = []
    for w in tokens:
        near = _NUMBER_TREE.within(w, 1) if len(w) >= NUMBER_LETTERS and w.isalpha() and w not in WORDS and w not in TENS and not _unit(w) else []
        out.append(near[0][2] if len({n for _, n, _ in near}) == 1 else w)
    return out


def _numbers(tokens: list[str]) -> list[str | float]:
    """Number words and ``and a half`` become numbers."""
    out: list[str | float] = []
    i = 0
    while i < len(tokens):
        w = tokens[i]
        if _NUMBER.match(w):
            out.append(float(w))
        elif w in TENS:
            n = TENS[w]
            j = i + 1 + (i + 1 < len(tokens) and tokens[i + 1] in ("-", "y"))
            if j < len(tokens) and 1 <= WORDS.get(tokens[j], 0) <= 9:
                n, i = n + WORDS[tokens[j]], j
            out.append(float(n))
        elif w in WORDS:
            out.append(float(WORDS[w]))
        elif w == "half" and len(out) >= 2 and out[-2:] == ["and", "a"] and len(out) > 2 and isinstance(out[-3], float):
            out[-3:] = [out[-3] + 0.5]
        elif w in ("media", "medio") and len(out) > 1 and out[-1] == "y" and isinstance(out[-2], float):
            out[-2:] = [out[-2] + 0.5]
        else:
            out.append(w)
        i += 1
    return out


def _unit(word: str | float | None) -> int:
    """Months per unit: 1 or 12; -1 for a unit that is no age; 0 if the word is no unit."""
    if not isinstance(word, str):
        return 0
    if word in MONTH_WORDS:
        return 1
    if word in YEAR_WORDS:
        return 12
    if word in OTHER_UNITS:
        return -1
    if len(word) >= 5:
        near = _UNIT_TREE.within(word, 2)
        if near and sorted(near[0][2]) == sorted(word) or near and near[0][0] <= 1:
            return 1 if near[0][2] in MONTH_WORDS else 12
    return 0


def age_forms(text: str, corrected: bool = False) -> tuple[str, str | None, bool]:
    """(name, ages, wrong_unit): the value without its ages, the ages as ``low-high m`` or
    ``by high m`` (months), and whether numbers stand with a unit that is no age. With ``corrected``
    number words may have a typing error."""
    words = _tokens(text)
    tokens = _numbers(_corrected(words) if corrected else words)
    nums = [i for i, w in enumerate(tokens) if isinstance(w, float)]
    used: set[int] = set()
    ages, wrong = None, False

    def around(i: int) -> tuple[int, set[int]]:
        """Unit of the number at i: the word after it, else the word before it."""
        j = i + 1
        u = _unit(tokens[j]) if j < len(tokens) else 0
        if u:
            taken = {j}
            while j + 1 < len(tokens) and tokens[j + 1] in ("old", "olds", "."):
                j += 1
                taken.add(j)
            return u, taken
        if i and tokens[i - 1] in ("age", "ages", "aged", "edad", "edades") or i and _unit(tokens[i - 1]) == 1:
            return _unit(tokens[i - 1]), {i - 1}
        if i and _unit(tokens[i - 1]) == -1:
            return -1, {i - 1}
        return 0, set()

    if len(nums) == 2:
        i, j = nums
        (u, a), (v, b) = around(i), around(j)
        between = [k for k in range(i + 1, j) if k not in a | b]
        if between and all(tokens[k] in RANGE_WORDS or tokens[k] in FILLER_WORDS for k in between):
            if u == -1 or v == -1:
                wrong = True
            low_unit, high_unit = u or v, v or u
            if not wrong and low_unit and high_unit:
                low, high = tokens[i] * low_unit, tokens[j] * high_unit
                ages = f"{low:g}-{high:g}m"
                used = {i, j, *a, *b, *between}
    elif len(nums) == 1:
        i = nums[0]
        u, a = around(i)
        before = [k for k in range(i) if k not in a]
        if u == -1:
            wrong = True
        elif u and before and (tokens[before[0]] == "by" or [tokens[k] for k in before] == ["a", "los"]) \
                and all(tokens[k] in BY_WORDS or tokens[k] == "a" for k in before):
            ages = f"by {tokens[i] * u:g}m"
            used = {i, *a, *before}
    rest = [f"{w:g}" if isinstance(w, float) else w for k, w in enumerate(tokens) if k not in used]
    if ages and all(w in FILLER_WORDS for w in rest):
        rest = []
    name = " ".join(w for w in rest if re.match(r"\w", w))
    return name, ages, wrong


def _name_form(name: str) -> str:
    """Pre-kindergarten is written in many ways; its year is part of the name."""
    m = re.fullmatch(r"(?:pk|p k|prek|pre k|pre kinder|prekinder|pre kindergarten|prekindergarten) ?(\d+)", name)
    return f"pk{m[1]}" if m else name


def _pk(text: str) -> str | None:
    t = " ".join(f"{w:g}" if isinstance(w, float) else w for w in _numbers(_tokens(text)))
    t = re.sub(r"[^a-z0-9]+", " ", t).strip()
    form = _name_form(t)
    return form if form != t or re.fullmatch(r"pk\d+", t) else None


def band_forms(bands: list[tuple[int, str, float | None, float | None]]) -> list[tuple[str, int]]:
    """Forms of each band (id, label, low, high) for the tree: names and ages."""
    out: list[tuple[str, int]] = []
    for band, label, low, high in bands:
        if label:
            pk = _pk(label)
            name, ages, _ = age_forms(label)
            if pk or name:
                out.append((pk or name, band))
            words = plain(label)
            if not re.search(r"\d", words):
                out.append((words, band))  # a name of number words, such as a range without a unit
            if ages:
                out.append((ages, band))
        low, high = (None if x is None or x != x else x for x in (low, high))
        if high is not None:
            out.append((f"{low:g}-{high:g}m" if low is not None else f"by {high:g}m", band))
    return sorted(set(out))


def threshold(form: str) -> int:
    """Edits forgiven in a name: two from eight letters on, one from six."""
    letters = sum(c.isalpha() for c in form)
    return 2 if letters >= 8 else 1 if letters >= 6 else 0


def _digits(form: str) -> list[str]:
    return re.findall(r"\d+(?:\.\d+)?", form)


def asked(text: str) -> dict[str, tuple[str, int]]:
    """What a value asks of a list: forms by kind, each with the edits forgiven. A year of
    pre-kindergarten asks for that alone, a number with a unit that is no age for nothing."""
    pk = _pk(text)
    if pk:
        return {"pk": (pk, 0)}
    name, ages, wrong = age_forms(text)
    if wrong:
        return {}
    out: dict[str, tuple[str, int]] = {}
    if name:
        out["name"] = (name, threshold(name))
    if ages:
        out["ages"] = (ages, 0)
        return out
    whole = plain(text)
    out["whole"] = (whole, threshold(whole))
    name, ages, wrong = age_forms(text, corrected=True)
    if ages and not name and not wrong:
        out["typo"] = (ages, 0)
    return out


def answered(tree: BKTree, forms: dict[str, tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(kind, distance, entry) of every entry of a tree within what is asked."""
    return [(kind, d, entry) for kind, (form, limit) in forms.items() for d, entry, found in tree.within(form, limit)
            if kind in ("pk", "ages", "typo") or _digits(found) == _digits(form)]


def decided(forms: dict[str, tuple[str, int]], answers: list[tuple[str, int, int]]) -> tuple[int, int]:
    """(band_id, distance) of the meant band, or (0, -1). A name that is met goes before ages; with both given
    they must agree."""
    met = {kind: sorted((d, entry) for k, d, entry in answers if k == kind) for kind in ("pk", "name", "ages", "whole", "typo")}
    found: list[tuple[int, int]] = []
    if "pk" in forms:
        found = met["pk"]
    elif met["name"]:
        by_age = {entry for _, entry in met["ages"]}
        found = [x for x in met["name"] if "ages" not in forms or x[1] in by_age]
    elif "ages" not in forms:
        found = met["whole"] or met["typo"]
    elif "name" not in forms:
        found = met["ages"]
    return (found[0][1], found[0][0]) if found else (0, -1)


def match_band(text: str, tree: BKTree) -> tuple[int, int]:
    """(band_id, distance) of the band a value means by a list that is one tree."""
    forms = asked(text)
    return decided(forms, answered(tree, forms))


def _mapped(rows: DataFrame, value: str, forms: list[tuple[str, int]]) -> DataFrame:
    """``rows`` with (band_id, distance) by a list that is one tree; each task remembers the distinct values it
    has met (at most ``MAX_BROADCAST``), so no shuffle is needed."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, known = BKTree(forms), {}
        for frame in frames:
            got = []
            for v in frame[value]:
                hit = known.get(v)
                if hit is None:
                    if len(known) >= MAX_BROADCAST:
                        known.clear()
                    hit = known[v] = match_band(v, tree)
                got.append(hit)
            out = frame.copy()
            out["band_id"] = pd.Series([g[0] for g in got], index=frame.index, dtype="int32")
            out["distance"] = pd.Series([g[1] for g in got], index=frame.index, dtype="int32")
            yield out

    return rows.mapInPandas(run, f"{fields}, band_id int, distance int")


def _mapped_by_shards(rows: DataFrame, value: str, forms: DataFrame, n: int) -> DataFrame:
    """The same by a list in shards: distinct values are staged once, every shard is sent along by itself and
    answers for them, and the answers to a value are decided on together."""
    spark = rows.sparkSession
    values = staged(rows.groupBy(value).agg(F.count("*").alias("n")), "typed-values")
    shards = -(-n // SHARD_FORMS)
    parts = []
    for i in range(shards):
        shard = [(r.form, r.entry) for r in forms.where(F.pmod(F.xxhash64("form"), F.lit(shards)) == i).collect()]  # about SHARD_FORMS
        sent = spark.sparkContext.broadcast(shard)

        def run(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            tree = BKTree(sent.value)
            for frame in frames:
                out = [(v, *hit) for v in frame[value] for hit in answered(tree, asked(v))]
                yield pd.DataFrame(out, columns=["value", "kind", "distance", "entry"])

        parts.append(staged(values.select(value).mapInPandas(run, "value string, kind string, distance int, entry int"), f"answers-{i}"))
        sent.unpersist()
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # Of a kind only the nearest entries and, for agreement of name and ages, all of both decide.
    told = every.groupBy("value").agg(F.collect_set(F.struct("kind", "distance", "entry")).alias("answers"))
    whole = values.join(told, F.col(value) == F.col("value"), "left").select(value, "n", "answers")

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [decided(asked(v), [(x["kind"], x["distance"], x["entry"]) for x in a] if a is not None else []) for v, a in
                   zip(frame[value], frame.answers, strict=True)]
            yield pd.DataFrame({value: frame[value], "n": frame.n, "band_id": [g[0] for g in got], "distance": [g[1] for g in got]})

    means = staged(whole.mapInPandas(decide, f"`{value}` string, n long, band_id int, distance int"), "value-bands")
    return salted_join(rows, means.drop("n"), [value], F.col("row_id"), counts=means)


def map_to_bands(rows: DataFrame, bands: DataFrame, value: str = "age_band") -> DataFrame:
    """(table_name, row_id, typed value, band_id, distance), one row per row id.

    ``rows`` has table_name, row_id and ``value``. The forms of the list are made by tasks and staged; at most
    ``MAX_BROADCAST`` of them, or a shard, come to the driver at once."""
    df = rows.where(F.regexp_replace(F.coalesce(F.col(value), F.lit("")), r"[\s\u00a0]+", "") != "").select(
        "table_name", "row_id", value)

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame(band_forms(list(zip(f.band_id, f.label, f.low_months, f.high_months, strict=True))), columns=["form", "entry"])

    listed = bands.where("band_id IS NOT NULL").select("band_id", "label", F.col("low_months").cast("double"), F.col("high_months").cast("double"))
    forms = staged(listed.mapInPandas(written, "form string, entry int").distinct(), "band-forms")
    n = forms.count()
    if n <= MAX_BROADCAST:
        found = _mapped(df, value, [(r.form, r.entry) for r in forms.collect()])
    else:
        found = _mapped_by_shards(df, value, forms, n)
    rank = F.struct(F.when(F.col("band_id") > 0, 1).otherwise(0), -F.col("distance"), -F.col("band_id"))
    return found.groupBy("table_name", "row_id").agg(
        F.max_by(F.struct(value, "band_id", "distance"), rank).alias("_w")).select(
        "table_name", "row_id", F.col(f"_w.{value}").alias(value), "_w.band_id", "_w.distance")
