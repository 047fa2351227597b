"""References, shredding and hierarchies against brute force, and their edge cases."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hierarq.operators import hierarchy, references, shred

T = [datetime(2024, 1, d) for d in range(1, 29)]
VERSIONED = "id long, domain_id long, strand_id long, deleted boolean, loaded_at timestamp_ntz, table_name string, period string"
GOLD = "set_id string, state string, test_case_id string, code string, parent_code string, loaded_at timestamp_ntz, reason string"


def _versioned(spark, rows):  # noqa: ANN001, ANN202
    return spark.createDataFrame([(i, d, s, x, t, "clash", "clash") for i, d, s, x, t in rows], VERSIONED)


def test_reasons_and_edges(spark) -> None:  # noqa: ANN001
    domains = _versioned(spark, [(1, None, None, False, T[0]), (2, None, None, False, T[0]), (2, None, None, True, T[5]),
                                 (3, None, None, False, T[9]), (4, None, None, True, T[0]), (4, None, None, False, T[3]),
                                 (None, None, None, False, T[0])])
    strands = _versioned(spark, [(10, 1, None, False, T[2]), (11, 2, None, False, T[6]), (12, 3, None, False, T[4]),
                                 (13, 99, None, False, T[4]), (13, 99, None, False, T[4]), (14, None, None, False, T[4]),
                                 (15, 99, None, True, T[4]), (16, 99, None, False, T[1]), (16, 1, None, False, T[2]), (17, 4, None, None, T[4])])
    subs = _versioned(spark, [(20, None, 10, False, T[9]), (21, None, 77, False, T[9])])
    gold = spark.createDataFrame([("s", "AZ", "a", " a1 ", None, T[0], "x"), ("s", "AZ", "b", "B", "A1", T[1], "x"), ("s", "AZ", "c", "C", "zz", T[1], "x"),
                                  ("s", "AZ", "d", "D", "  ", T[1], "x"), ("s", "CA", "e", "E", "zz", T[1], "x"), ("s", "AZ", "f", "F", "g", T[1], "x"),
                                  ("s", "AZ", "g", "G", None, T[8], "x"), ("s", "AZ", "c", "C", "zz", T[1], "x")], GOLD)
    got = {tuple(r) for r in references.broken_references(domains, strands, subs, gold).collect()}
    assert got == {("strands", "2024-01", "11", "deleted"), ("strands", "2024-01", "12", "late"), ("strands", "2024-01", "13", "missing"),
                   ("sub_strands", "2024-01", "21", "missing"), ("golden_elements", "2024-01", "c", "missing"),
                   ("golden_elements", "2024-01", "f", "late")}


def test_references_of_empty_tables(spark) -> None:  # noqa: ANN001
    none = _versioned(spark, [])
    assert references.broken_references(none, none, none, spark.createDataFrame([], GOLD)).count() == 0


def _records(spark, payloads):  # noqa: ANN001, ANN202
    rows = [(i, p, T[0], "clash") for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "record_id long, payload string, received_at timestamp_ntz, label string")


def _elements(payloads):  # noqa: ANN001, ANN202
    """Brute force: which field names hold arrays of objects, then all elements."""
    trees = []
    for p in payloads:
        try:
            trees.append(json.loads(p))
        except (ValueError, TypeError):
            trees.append(None)

    def obj(v):  # noqa: ANN001, ANN202
        if isinstance(v, str) and v.strip().startswith("{") and v.strip().endswith("}"):
            try:
                w = json.loads(v)
            except ValueError:
                return v
            return w if isinstance(w, dict) else v
        return v

    arrays: set[str] = set()

    def scan(v):  # noqa: ANN001, ANN202
        v = obj(v)
        if isinstance(v, dict):
            for k, x in v.items():
                if isinstance(x, list) and any(isinstance(obj(y), dict) for y in x):
                    arrays.add(k)
                scan(x)
        elif isinstance(v, list):
            for x in v:
                scan(x)

    out = set()

    def walk(rid, v, path, parent, name):  # noqa: ANN001, ANN202
        v = obj(v)
        if isinstance(v, dict):
            for k, x in v.items():
                x = obj(x)
                p = f"{path}.{k}"
                if isinstance(x, dict) and k in arrays:
                    out.add((rid, parent, p + "[0]"))
                    walk(rid, x, p + "[0]", p + "[0]", k)
                else:
                    walk(rid, x, p, parent, k)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                p = f"{path}[{i}]"
                if isinstance(obj(x), dict):
                    out.add((rid, parent, p))
                    walk(rid, x, p, p, name)
                else:
                    walk(rid, x, p, parent, name)

    for t in trees:
        scan(t)
    for i, t in enumerate(trees):
        if isinstance(obj(t), (dict, list)):
            walk(i, t, "$", "$", None)
    return out


def test_array_elements_match_brute_force(spark, small) -> None:  # noqa: ANN001
    import pandas as pd

    own = ['{"a":[{"b":{"x":1}},null,{"b":[{"x":2},3]}]}', '{"a":{"b":null}}', "null", "[]", "", None, "{", '{"a":"{\\"a\\":[{}]}"}', '{"c":{"d":1}}',
           '[{"a":1}]', '{"a":[[{"z":1}]]}', '{"deep":' + '{"deep":' * 300 + "{}" + "}" * 301]
    real = pd.read_parquet(small + "/canonical_records.parquet").drop_duplicates("record_id").payload.tolist()
    payloads = own + real
    got = {tuple(r) for r in shred.array_elements(_records(spark, payloads)).collect()}
    assert got == {(a, b, c) for a, b, c in _elements(payloads)}


def test_entities_keep_links(spark) -> None:  # noqa: ANN001
    n = shred.nodes(_records(spark, ['{"r":[{"id":1,"c":[{"t":"x"},{"t":null}]},{"id":2}],"tags":["p",null,"q"]}']))
    paths = shred.object_paths(n)
    rows = {r.node_path: (r.parent_path, r.t) for r in shred.entity(n, paths, "$.r.c", ["t"]).collect()}
    assert rows == {"$.r[0].c[0]": ("$.r[0]", "x"), "$.r[0].c[1]": ("$.r[0]", None)}
    assert [(r.ordinal, r.scalar) for r in shred.scalar_lists(n, paths).orderBy("ordinal").collect()] == [(0, "p"), (2, "q")]


def test_entities_of_the_real_table_match_brute_force(spark, small) -> None:  # noqa: ANN001
    """Every object of the payloads with its scalar fields, and every entity table as the part of it that it is."""
    import pandas as pd

    from hierarq.plans import records

    def text(v):  # noqa: ANN001, ANN202
        return v if isinstance(v, str) else json.dumps(v)

    want: dict = {}

    def walk(rid, v, where):  # noqa: ANN001, ANN202
        v = shred._embedded(v)
        if isinstance(v, dict):
            fields = {k: shred._embedded(x) for k, x in v.items()}
            want.setdefault(rid, []).append({k: text(x) for k, x in fields.items() if x is not None and not isinstance(x, (dict, list))})
            for k, x in fields.items():
                walk(rid, x, f"{where}.{k}")
        elif isinstance(v, list):
            for x in v:
                walk(rid, x, where)

    real = pd.read_parquet(small + "/canonical_records.parquet").sort_values("received_at").drop_duplicates("record_id")
    for rid, payload in zip(real.record_id, real.payload, strict=True):
        walk(rid, shred._parse(payload) if payload is not None else None, "$")
    key = lambda d: sorted((k, v) for k, v in (d or {}).items())
    every = records.QUERIES["p5_objects"](spark, small).collect()
    got: dict = {}
    for r in every:
        got.setdefault(r.record_id, []).append(dict(r.scalars or {}))
    assert {k: sorted(map(key, v)) for k, v in got.items()} == {k: sorted(map(key, v)) for k, v in want.items()}
    for name, entity in records.ENTITIES.items():
        rows = records.QUERIES[name](spark, small)
        own = {(r.record_id, r.node_path): {k: v for k, v in r.asDict().items() if v is not None and k not in ("record_id", "node_path", "parent_path")} for r in rows.collect()}
        assert own == {(r.record_id, r.node_path): dict(r.scalars or {}) for r in every if r.entity == entity}, name


def test_every_object_has_a_row_and_a_parent(spark, small, monkeypatch) -> None:  # noqa: ANN001
    from hierarq.plans import records

    own = ['{"x":1,"c":[{"t":"a","r":[{"t":"b","r":[{"t":"c","T":"d","node_path":"e"}]}]}],"o":{"p":{"q":2}}}', '[{"x":3},{"c":[]}]', "1"]
    n = shred.nodes(_records(spark, own))
    paths = shred.object_paths(n)
    every = {(r.record_id, r.node_path): r for r in shred.objects(n, paths).collect()}
    assert {k: (r.entity, r.parent_path) for k, r in every.items()} == {
        (0, "$"): ("$", None), (0, "$.c[0]"): ("$.c", "$"), (0, "$.c[0].r[0]"): ("$.c.r", "$.c[0]"),
        (0, "$.c[0].r[0].r[0]"): ("$.c.r", "$.c[0].r[0]"), (0, "$.o"): ("$.o", "$"), (0, "$.o.p"): ("$.o.p", "$"),
        (1, "$"): ("$", None), (1, "$[0]"): ("$", "$"), (1, "$[1]"): ("$", "$")}
    assert every[0, "$.o.p"].scalars == {"q": "2"}
    replies = shred.entity(n, paths, "$.c.r")
    assert sorted(tuple(r[c] for c in ("node_path", "T", "t_", "node_path_")) for r in replies.collect()) == [
        ("$.c[0].r[0]", None, "b", None), ("$.c[0].r[0].r[0]", "d", "c", "e")]
    met = {r.entity for r in records.QUERIES["p5_objects"](spark, small).select("entity").distinct().collect()}
    assert met <= set(records.ENTITIES.values()) and "$.metadata.reviews.comments.replies" in met
    got = records.QUERIES["p5_roots"](spark, small)
    assert {"country", "state"} <= set(got.columns) and got.where("parent_path IS NOT NULL AND parent_path <> '$'").count() == 0
    monkeypatch.setattr(shred, "MAX_COLUMNS", 0)
    assert [r.scalars for r in shred.entity(n, paths, "$.o.p").collect()] == [{"q": "2"}]


def test_many_field_names_are_joined(spark, monkeypatch) -> None:  # noqa: ANN001
    data = _records(spark, ['{"a":[{"b":{"x":1}}]}', '{"a":{"b":[{"x":2}]}}'])
    want = {tuple(r) for r in shred.array_elements(data).collect()}
    monkeypatch.setattr(shred, "MAX_FIELDS", 0)
    assert {tuple(r) for r in shred.array_elements(data).collect()} == want


def _tree_rows(spark, rows):  # noqa: ANN001, ANN202
    return spark.createDataFrame([(*r, "clash") for r in rows], "set_id string, code string, parent_code string, path string")


def _walk(rows):  # noqa: ANN001, ANN202
    parent = {}
    for s, c, p in rows:
        k = (s, c)
        parent[k] = min([x for x in (parent.get(k), p) if x is not None], default=None)
    out = {}
    for s, c in parent:
        seen, at = [], c
        while at is not None and (s, at) in parent and at not in seen:
            seen.append(at)
            at = parent[(s, at)]
        looped = at is not None and at in seen
        out[(s, c)] = (None, looped and at == c, looped and at != c) if looped else (seen[::-1], False, False)
    # a node is on a circle if the walk comes back to it
    return out


@pytest.mark.parametrize("seed", [0, 3])
@pytest.mark.parametrize(("rows_per_task", "fragments"), [(100_000, 4), (25, 6), (7, 3)])
def test_hierarchies_match_brute_force(spark, seed, rows_per_task, fragments) -> None:  # noqa: ANN001
    rng = random.Random(seed)
    rows = []
    for s in ("s1", "s2"):
        n = 60 if s == "s1" else 25
        names = [f"C{i}" for i in range(n)]
        rng.shuffle(names)
        for i, c in enumerate(names):
            if seed == 3 and s == "s1":  # one long chain in scattered order that runs into a circle
                rows.append((s, c, names[i - 1] if i else names[5]))
            else:
                p = rng.choice([None, "gone", names[rng.randrange(n)], names[max(0, i - 1)], names[i // 3]])
                rows.append((s, c, p))
    full = hierarchy.hierarchies(_tree_rows(spark, rows), fragment_rows=rows_per_task, fragments=fragments)
    got = {(r.set_id, r.code): (list(r.path) if r.path is not None else None, r.on_circle, r.below_circle) for r in full.collect()}
    want = {k: ([*v[0]] if v[0] else None, v[1], v[2]) for k, v in _walk([(s, c.upper(), p.upper() if p else p) for s, c, p in rows]).items()}
    assert got == want


@pytest.mark.parametrize(("rows_per_task", "fragments"), [(100_000, 4), (7, 3)])
def test_descendants_below_circles_match_brute_force(spark, rows_per_task, fragments) -> None:  # noqa: ANN001
    rng = random.Random(5)
    rows = [("s", f"C{i}", f"C{(i + 1) % 3}" if i < 3 else "C9" if i == 9 else rng.choice([None, "C0", "C9", f"C{rng.randrange(i)}", f"C{i - 1}"]))
            for i in range(60)]
    circular = {"C0", "C1", "C2", "C9"}
    parent = {c: p for _, c, p in rows}
    want = set()
    for c in parent:
        at, distance = parent[c], 1
        while c not in circular and at is not None and at not in circular:
            want.add(("s", at, c, distance))
            at, distance = parent[at], distance + 1
    full = hierarchy.hierarchies(_tree_rows(spark, rows), fragment_rows=rows_per_task, fragments=fragments)
    got = [tuple(r) for r in hierarchy.descendants(full).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    below = {r.code for r in full.where("below_circle").collect()}
    assert {x for x in want if x[1] in below}
    counts = {r.code: r.descendants for r in hierarchy.paths(full).collect()}
    assert counts == {c: sum(x[1] == c for x in want) for c in parent}


def test_hierarchy_edges(spark) -> None:  # noqa: ANN001
    rows = [("s", " a ", None), ("s", "b", "A"), ("s", "b", "A"), ("s", "c", "c"), ("s", "d", "C"), ("s", None, "a"), ("s", " ", "a"), ("t", "b", "a"),
            (None, "x", " ")]
    full = hierarchy.hierarchies(_tree_rows(spark, rows))
    got = {(r.set_id, r.code): (r.path, r.depth, r.root, r.descendants) for r in hierarchy.paths(full).collect()}
    assert got == {("s", "A"): ("A", 0, "A", 1), ("s", "B"): ("A > B", 1, "A", 0), ("s", "C"): (None, None, None, 0),
                   ("s", "D"): (None, None, None, 0), ("t", "B"): ("B", 0, "B", 0), ("", "X"): ("X", 0, "X", 0)}
    assert [tuple(r) for r in hierarchy.circles(full).collect()] == [("s", "C")]
    assert hierarchy.hierarchies(_tree_rows(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1, 11), min_size=1, max_size=12))
def test_contraction_of_one_partition(parents) -> None:  # noqa: ANN001
    rows = [(str(i), None if p < 0 else str(p), [str(i)], "open") for i, p in enumerate(parents)]
    for k, exit_, seg, status in hierarchy.contract(rows):
        at, seen = int(k), []
        while at >= 0 and at < len(parents) and at not in seen:
            seen.append(at)
            at = parents[at]
        if at in seen:
            assert status == ("cycle" if at == int(k) else "below")
        else:
            assert seg == [str(x) for x in reversed(seen)]
            assert (status, exit_) == (("tree", None) if at < 0 else ("open", str(at)))
