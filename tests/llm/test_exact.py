"""Exact dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pricegrain.llm import exact

SCHEMA = "doc_id long, text string, run int, sha string"


def brute(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for plain, members in groups.items():
        first = min(members)
        for m in members:
            out.append((rows[m[3]][0], rows[first[3]][0], len(members), hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=1):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)
    return exact.exact_duplicates(df).collect()


ODD = [(None, None), (None, ""), (3, " \t\n"), (3, " \t\n"), (1, "a b"), (2, "ab "), (5, "ab"), (2, "ab "), (7, "é à"), (6, "éà"), (8, "ab "), (None, "long"), (9, "x " * 50_000), (10, "x" * 50_000)]


def test_odd_rows(spark):
    got = found(spark, ODD)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(ODD)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}  # also where id and text are repeated


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("parts,fan", [(1, 4), (7, 1), (40, 2), (40, 4)])
def test_many_runs_and_one_frequent_text(spark, monkeypatch, parts, fan):
    monkeypatch.setattr(exact, "FAN_BITS", fan)
    monkeypatch.setattr(exact, "RUN_ROWS", 10)
    rng = random.Random(parts)
    rows = [(i, "the same" if rng.random() < 0.4 else " ".join(rng.choice("abc") for _ in range(rng.randint(0, 5)))) for i in range(600)]
    got = found(spark, rows, parts)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_equal_short_digests_are_verified(spark, monkeypatch):
    monkeypatch.setattr(exact, "short_digest", lambda text: F.length(text).cast("long"))
    rows = [(i, t) for i, t in enumerate(["ab", "cd", "a b", "dc", "c d "])]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found(spark, rows, 3)), key=str) == brute(rows)


def test_plan_has_no_python(spark):
    plan = exact.exact_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
