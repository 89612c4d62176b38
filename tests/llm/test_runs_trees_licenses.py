"""Periodic runs, the Merkle manifest and the license scan: brute force, SQL on invented rows, odd rows."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arrivals.llm import licenses, merkle, periods
from arrivals.llm.license_rules import rules

from .conftest import EXTRA, ODD, passage

duckdb = pytest.importorskip("duckdb")


# Periodic runs


def brute_runs(words):
    """All (start, length, period), by comparing every distance and every smaller period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        x = 0
        while x + q < n:
            begin = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            length = x - begin + q
            if length >= max(6, 4 * q) and not any(words[begin : begin + length - p] == words[begin + p : begin + length] for p in range(1, q)):
                out.append((begin, length, q))
            x = max(x, begin + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def loops(rng, n, kinds, times):
    words = [f"{rng.choice('abcdefgh'[: min(8, kinds)])}{rng.randrange(max(1, kinds // 8 + 1))}" for _ in range(n)]
    for _ in range(times if n > 12 else 0):
        a = rng.randrange(n - 8)
        q = rng.randint(1, max(1, (n - a) // 4))
        for i in range(a, min(n, a + rng.randint(3 * q, 6 * q + 2))):
            words[i] = words[a + (i - a) % q]
    return words


def test_runs_equal_brute_force():
    rng, found, periods_found = random.Random(1), 0, set()
    for _ in range(60):
        texts = [loops(rng, rng.choice([0, 1, 5, 30, 120, 400]), rng.choice([1, 2, 4, 400]), rng.randint(0, 3)) for _ in range(rng.randint(0, 5))]
        got = periods._described(pa.array([*(" ".join(w) for w in texts), None], pa.string())).to_pylist()
        assert got.pop() == {"runs": [], "collapsed": ""}
        for words, one in zip(texts, got, strict=True):
            expected = brute_runs(words)
            assert [(r["start"], r["length"], r["period"]) for r in one["runs"]] == expected
            assert one["collapsed"] == brute_collapsed(words, expected)
            found += len(expected)
            periods_found |= {q for _, _, q in expected}
    assert found > 80 and max(periods_found) > 50 and len(periods_found) > 15


def test_runs_do_not_cross_texts_and_slices(make, monkeypatch):
    rows = [(i, "a b " * n, "", "") for i, n in enumerate([1, 2, 3, 4, 30, 3, 1])]
    expected = [[], [], [], [(0, 8, 2)], [(0, 60, 2)], [], []]
    found = periods.periodic_runs(make(rows)).collect()
    # The tables of the tests have a column `found`, and keep it.
    assert {r["found"] for r in found} == {"found"}
    assert [[tuple(x) for x in r["runs"]] for r in sorted(found, key=lambda r: r["doc_id"])] == expected
    assert {r["collapsed"] for r in found if r["doc_id"] > 2} == {"a b", "a b a b a b"}
    for size in (1, 20, 50):
        monkeypatch.setattr(periods, "TOGETHER", size)
        (cut,) = periods._of_texts(iter([pa.array([r[1] for r in rows])]))
        assert [[tuple(x.values()) for x in r["runs"]] for r in cut.to_pylist()] == expected


def test_op11_equals_brute_force(spark, make, tmp_path):
    rng = random.Random(4)
    rows = [(i, " \t".join(loops(rng, rng.choice([1, 7, 60, 200]), rng.choice([3, 400]), 1)), "", "") for i in range(200)]
    rows += [(None, "x " * 9, "", ""), (901, None, "", ""), (902, "\n", "", ""), (903, passage(2, 900), "", ""), (903, passage(2, 900), "", "")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        one = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((doc_id, len(runs), *one, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(brute_collapsed(words, runs))))
    found = periods.op11_periodic_runs(spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert dict(found.dtypes)["start"] == dict(found.dtypes)["exponent_milli"] == "bigint"


def test_collapse_keeps_columns_and_other_texts(make):
    rows = [(1, "go  on\n" + "again and " * 5, "en", "a"), (2, "go  on\nthen", "en", None), (3, None, None, "b")]
    docs = make(rows)
    out = periods.collapse(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["text"] for i in (1, 2, 3)] == ["go on again and", "go  on\nthen", None]
    assert all([r[c] for c in EXTRA] == EXTRA for r in got.values())


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    """Levels from the nodes to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of rows of doc_id, source, lang, n_chars, text."""

    def leaf(*fields):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = {}
    for d, s, lang, n, text in rows:
        old = leaf(d, s, lang, n, text)
        change = d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None
        leaves.setdefault(s, []).append((d is None, d or 0, old, leaf(d, s, lang, n, text.translate(lower)) if change else old, d))
    names = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(leaves[s])]) for s in names}
    top = brute_tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (_, _, old, new, d) in enumerate(sorted(leaves[s])):
            proof, folded = "", new
            for levels, i in ((trees[s], at), (top, k)):
                for level in levels[:-1]:
                    first = i - i % 16
                    before, after = "".join(level[first:i]), "".join(level[i + 1 : first + 16])
                    proof += before + after
                    folded = sha(before + folded + after)
                    i //= 16
            out.append((d, old, trees[s][-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return out


FIELDS = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, digest string, tree string"


def documents(spark, rows, path):
    spark.createDataFrame([(*r, "x", "y", "z") for r in rows], FIELDS).write.parquet(f"{path}/documents.parquet")
    return merkle.op12_merkle(spark, str(path))


def test_op12_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 70)
    rng = random.Random(2)
    # A third of all rows in one source, beyond two blocks; sources of one, 16, 17 and 257 rows; 40 small ones.
    sizes = {"hot": 700, None: 1, "": 16, "Ärger": 17, "b": 257, "B": 1, **{f"s{i}": i % 3 + 1 for i in range(40)}}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            text = rng.choice([None, "", "Some TEXT", "ÄÖ no capitals", "x" * 5000, f"Number {i}"])
            rows.append((i * 7, source, rng.choice([None, "en"]), rng.choice([None, i]), text))
    rows += [(None, "b", "en", 1, "A"), (None, "b", "en", 1, "A"), (rows[5][0], "b", None, None, "Twice"), (rows[5][0], "b", None, None, "Twice")]
    rng.shuffle(rows)
    found = documents(spark, rows, tmp_path)
    got = [tuple(r) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_manifest(rows)))
    assert not all(r[-1] for r in got)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    said = connection.execute(merkle.SQL["op12_merkle"])
    assert [c[0] for c in said.description] == found.columns
    assert sorted(map(repr, said.fetchall())) == sorted(map(repr, got))


@pytest.mark.parametrize("n", [0, 1])
def test_op12_of_few_rows(spark, tmp_path, n):
    rows = [(1, None, None, None, None)] * n
    got = [tuple(r) for r in documents(spark, rows, tmp_path).collect()]
    assert got == ([(1, *(3 * [sha("1:1----")]), sha(""), sha("1:1----"), True)] if n else [])


def test_versions_share_all_but_the_way_to_the_root(spark):
    docs = spark.createDataFrame([(i, "a", "en", i, f"T{i}") for i in range(300)], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = {r["doc_id"]: r for r in merkle.manifest(docs, F.when(F.col("doc_id") == 299, F.lit("other"))).collect()}
    assert all(len(r["copied"]) == 4 and r["copied"][0] == r["leaf"] and r["copied"][-1] == r["root"] for i, r in found.items() if i != 299)
    # 300 leaves, 19 nodes, 2, 1.
    old, new = brute_tree([found[i]["leaf"] for i in range(300)]), brute_tree([found[i]["leaf"] for i in range(299)] + [found[299]["copied"][0]])
    assert found[299]["copied"] == [level[-1] for level in new]
    assert [sum(a != b for a, b in zip(*levels, strict=True)) for levels in zip(old, new, strict=True)] == [1, 1, 1, 1]
    assert merkle.manifest(docs).filter("element_at(copied, -1) <> root").count() == 0


# License scan


def brute_scan(text):
    """Detections by the rules with words as a list: base places, kept spans."""
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    joined = " ".join(words)
    starts = {sum(len(w) + 1 for w in words[:i]): i for i in range(len(words))}
    ends = {p + len(words[i]): i + 1 for p, i in starts.items()}
    found = []
    for r in rules():
        at = 0
        pattern = re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])")
        while m := pattern.search(joined, at):
            found.append((starts[m.start()], ends[m.end()], r))
            at = m.end()
    outer = [
        d for d in found
        if not any(o[0] <= d[0] and o[1] >= d[1] and o[2].rank <= d[2].rank and (o[0], -o[1], o[2].number) < (d[0], -d[1], d[2].number) for o in found)
    ]
    kept = [d for d in outer if not any(o[2].rank < d[2].rank and o[0] < d[1] and o[1] > d[0] for o in outer)]
    return len(words), [d for d in found if d[2].base], kept


NOTICES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.",
    "All rights reserved. All Rights Reserved, ALL RIGHTS-RESERVED",
    "CC BY-NC-SA 4.0, CC BY 3.0 and cc by",
    "GNU Lesser General Public License version 2.1 or the GNU Affero General Public License v3",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Copyright (c) 2019, 2020 by me; some rights reserved. SPDX-License-Identifier: GPL-2.0-or-later",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "general public library, all rights are reserved, success by mit dem Affen",
]


def test_scan_equals_brute_force_and_its_sql(spark, make, tmp_path):
    rng = random.Random(8)
    filler = [passage(i, 12) for i in range(6)] + ["license", "gpl", "version 2", "2.0", "public", "the ÀÉ licence", "cc"]
    rows = [(i, " ".join(rng.choice(NOTICES + filler) for _ in range(rng.randint(0, 8))), "", "") for i in range(150)]
    rows += [(900, None, "", ""), (901, "", "", ""), (902, " .,-\x00\x7f", "", ""), (903, NOTICES[1] * 400, "", ""), (903, NOTICES[1] * 400, "", ""), (None, NOTICES[3], "", "")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = licenses.op13_licenses(spark, str(tmp_path))
    got = [tuple(r) for r in found.collect()]
    expected = []
    for doc_id, text, *_ in rows:
        n, base, kept = brute_scan(text)
        first = [d[0] for d in base]
        score = max((licenses.CONFIDENCE[d[2].rank] for d in kept), default=0.0)
        base_labels = {d[2].label for d in base}
        labels = base_labels | {d[2].label for d in kept}
        expected.append((doc_id, n, len(base), min(first, default=None), max(first, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score))
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert any(x[2] > 300 for x in got)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    said = connection.execute(licenses.SQL["op13_licenses"])
    order = [[c[0] for c in said.description].index(c) for c in found.columns]
    assert sorted(repr(tuple(r[i] for i in order)) for r in said.fetchall()) == sorted(map(repr, got))
    assert dict(found.dtypes)["first_word"] == dict(found.dtypes)["n_words"] == "bigint"


def test_rules_are_sound():
    listed = rules()
    assert len(listed) > 200 and [r.number for r in listed] == list(range(len(listed)))
    assert [r.rank for r in listed] == sorted(r.rank for r in listed)
    assert {(r.label, r.pattern) for r in listed if r.base} == {("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")}
    rng = random.Random(3)
    for r in listed:
        # Whatever the pattern matches holds the keyword.
        for _ in range(30):
            text = sample(re._parser.parse(r.pattern), rng)
            assert re.fullmatch(r.pattern, text) and "  " not in text, (r, text)
            assert licenses.keyword_of(r) in f" {text.replace(' ', '  ')} ", (r, text)


def sample(parsed, rng):
    """A text that a parsed pattern matches."""
    out = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            out += "z" if str(arg[0][0]) == "NEGATE" else chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])
        elif name == "NOT_LITERAL":
            out += "z"
        elif name == "BRANCH":
            out += sample(rng.choice(arg[1]), rng)
        elif name == "SUBPATTERN":
            out += sample(arg[-1], rng)
        elif name == "MAX_REPEAT":
            least, most, what = arg
            out += "".join(sample(what, rng) for _ in range(rng.randint(least, min(int(most), least + 2))))
        else:
            raise ValueError(name)
    return out


def test_overlaps_are_resolved(make):
    rows = [(1, "released under the MIT license", "", ""), (2, "GPL version 2 or later", "", ""), (3, "the GNU General Public License, version 3, all rights reserved", "", "")]
    got = {r["doc_id"]: r for r in licenses.scan(make(rows)).collect()}
    assert [x["label"] for x in got[1]["spans"]] == ["mit"] and got[1]["score"] == 1.0
    assert got[1]["spans"][0]["first"] == 0 and got[1]["spans"][0]["stop"] == 5
    assert got[2]["labels"] == ["gpl-2.0-or-later"]
    assert got[3]["base_labels"] == ["gpl", "reserved"] and got[3]["labels"] == ["gpl", "gpl-3.0", "reserved"]


@pytest.mark.parametrize("run", [periods.periodic_runs, merkle.manifest, licenses.scan])
def test_odd_and_empty_tables(run, odd):
    docs = odd.withColumn("n_chars", F.length("text").cast("bigint"))
    assert run(docs).count() == len(ODD)
    assert run(docs.limit(0)).collect() == []


def test_scan_stays_in_the_jvm(spark, make):
    plan = licenses.matches(make(ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
