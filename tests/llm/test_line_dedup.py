import pytest

from eventmart.llm import line_dedup as L
from eventmart.llm.line_runs import LineRuns, as_they_lie


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)

    ids = [L.LEAST if i is None else i for i, _ in rows]
    holders = {}
    for doc, (_, text) in zip(ids, rows):
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, (doc_id, text) in zip(ids, rows):
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if len(key(line)) < min_chars or len(holders[key(line)]) < min_docs or doc == max(holders[key(line)])
        ]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("batches,fan_in", [(4, 2), (1, 2), (7, 3)])
def test_equals_brute_force(spark, docs, prose, batches, fan_in):
    line = "a line that many of the documents share"
    rows = list(enumerate(prose)) + [(200 + k, f"own {k}\n {line.upper()} \r\nend\n{line}") for k in range(20)]
    rows += [(210, "row of the same document\n" + line), (None, line), (None, f"{line}\n{line}"), (230, "é" * 19), (231, "é" * 19), (232, "é" * 19)]
    rows += [(240 + k, "é" * 20) for k in range(3)] + [(250 + k, "É" * 20) for k in range(2)] + [(-5, line)]
    given = docs(*rows, extra=("n_lines", "doc", "h1", "Body", "hashes", "__doc", "__hashes"))
    found = L.dedup_lines(given, batches=batches, runs=LineRuns(spark, fan_in=fan_in))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "doc", "h1", "Body", "hashes", "__doc", "__hashes", "n_lines", "n_dropped"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))
    assert sum(n for *_, n in got) > 20


def test_many_rows_under_one_id_are_gathered_by_text(spark, docs):
    line = "a line that many of the documents share"
    rows = [(7, f"text {k % 50}\n{line}") for k in range(300)] + [(8, line), (9, f"{line}\nend"), (None, line)]
    found = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in L.dedup_lines(docs(*rows)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, brute(rows)))
    assert L.drops(docs(*rows)).filter("doc = 7").count() == 50


def hashes(spark, *rows):
    return spark.createDataFrame(rows, "doc long, h1 long, h2 long")


def test_runs_stay_few_and_hold_each_keeper_once(spark):
    runs = LineRuns(spark)
    for batch in range(4):
        runs.add(hashes(spark, *((30 - 10 * batch + k, k % 5, 0) for k in range(10))), 10)
        assert len(runs.names) == (1, 1, 2, 1)[batch]
    assert sorted((r.h1, r.n_docs, r.keeper) for r in runs.table(runs.names[0]).collect()) == [(k, 8, 35 + k) for k in range(5)]
    runs.forget_tables()


def test_runs_are_neither_shuffled_nor_sorted_again(spark):
    runs = LineRuns(spark, fan_in=3)
    for batch in range(2):
        runs.add(hashes(spark, *((k, k % 300 + 100 * batch, k % 7) for k in range(1_000))), 1_000)
    one, two = runs.names
    with as_they_lie(spark):
        joined = runs.with_keepers(runs.table(two))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "LeftAnti" in plan
        assert "Exchange" not in plan and "Sort [" not in plan
        assert "Exchange" not in runs.merged()._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == runs.table(two).count() and joined.filter("keeper IS NOT NULL").count() == 0
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == "false"
    runs.forget_tables()


def test_later_documents_meet_the_runs_of_earlier_ones(spark, docs, prose, tmp_path):
    folder = str(tmp_path / "runs")
    often, rare = "a line that many of the documents share", "a line that only few documents share"
    first = [(k, f"own {k}\n{often}\n{rare if k == 5 else ''}") for k in range(10)]
    second = [(k, f"own {k}\n{often}\n{rare}") for k in range(100, 102)]
    runs = LineRuns(spark, folder)
    assert L.dedup_lines(docs(*first), runs=runs).agg({"n_dropped": "sum"}).first()[0] == 9
    failed = LineRuns(spark, folder)  # opened before the first call has published
    runs.publish()
    with pytest.raises(RuntimeError, match="other runs"):
        failed.publish()
    for _ in range(2):  # the first of these is not published, so it leaves no trace
        runs = LineRuns(spark, folder)
        kept = {r.doc_id: r.text for r in L.dedup_lines(docs(*second), runs=runs).collect()}
        # The keepers of both lines are among the first documents.
        assert kept == {k: f"own {k}" for k in range(100, 102)}
    runs.publish()
    runs.sweep()
    assert {p.name for p in (tmp_path / "runs").iterdir() if p.is_dir()} == set(runs.names)
    assert L.dedup_lines(docs((200, rare)), runs=LineRuns(spark, folder)).first().text == ""


def test_empty_table(spark, docs):
    assert L.dedup_lines(docs("a").limit(0)).count() == 0
    assert [tuple(r) for r in L.dedup_lines(docs(None, "").select("doc_id", "text")).collect()] == [(0, "", 1, 0), (1, "", 1, 0)]
