from __future__ import annotations

import random

import llm_helpers as H
import pytest

from ledgerloom.llm import line_runs


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(H.LOWER)


def expected(rows):
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= 10 and (k not in first or order(i) < order(first[k])):
                first[k] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def cases():
    rnd = random.Random(4)
    pool = [H.prose(k, 4) for k in range(60)] + ["short", "", "  Padded Line of text\t", "padded line of text", "ÄÖÜ ÄÖÜ ÄÖÜ", "äöü äöü äöü", "É is not e, Éé"]
    rows = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for k in range(150)]
    rows += [(1000 + k, "one line that very many documents hold\nown line of number " + str(k)) for k in range(200)]
    rows += H.AWKWARD + [(None, "one line that very many documents hold\nonly without an id"), (None, "only without an id\nx"), (3000, "the same row twice\nq"), (3000, "the same row twice\nq")]
    rows += [(4000, "\n".join(f"line number {k} of a long text" for k in range(5000))), (4001, "\n".join(f"Line number {k} of a long text " for k in range(0, 5000, 3)))]
    rows += [(5000, "\n\n\n"), (5001, "ends with a break and blanks \n"), (5002, " ends with a break and blanks")]
    return rows


@pytest.mark.parametrize(("batches", "fan_in"), [(1, 2), (4, 2), (9, 2), (9, 3)])
def test_lines_match_plain_python(spark, monkeypatch, batches, fan_in):
    monkeypatch.setattr(line_runs, "FAN_IN", fan_in)
    rows = cases()
    got = line_runs.without_repeated_lines(H.documents(spark, rows), batches).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in got) == expected(rows)


def test_levels_are_merged_and_runs_stay_disjoint(spark):
    index = line_runs.LineIndex(spark, 4)
    for batch in range(11):
        hashes = spark.range(batch * 5, batch * 5 + 10).selectExpr("id as h1", "id * 7 as h2")  # half of them known
        marked = index.marked(hashes).cache()
        assert {r.h1 for r in marked.where("old").collect()} == set(range(batch * 5, batch * 5 + (5 if batch else 0)))
        index.add(marked.where("not old"))
    assert all(len(level) <= line_runs.FAN_IN for level in index.levels) and len(index.levels) >= 3
    everything = [r.h1 for run in index.runs() for r in spark.table(run).collect()]
    assert sorted(everything) == list(range(60))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # large runs are never broadcast: then only the batch is shuffled
        hashes = spark.range(9).selectExpr("id as h1", "id as h2").groupBy("h1", "h2").count()
        plan = index.marked(hashes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == plan.count("Bucketed: true") == len(index.runs())
    names = index.runs()
    index.drop()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_empty_table_and_native_plan(spark):
    empty = line_runs.without_repeated_lines(H.documents(spark, []))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    plan = line_runs.without_repeated_lines(H.documents(spark, cases()[:5]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
