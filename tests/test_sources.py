from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.pipeline import run_clean
from ledgerloom.sources.fingerprint import arrival_fingerprint, differing_leaves, ledger_fingerprint, ledger_tree
from ledgerloom.sources.manifest import source_files
from ledgerloom.sources.sheets import TEXT_POSITION, read_sheets, read_text_sheets, refuse_broken_records, sheet_position, snapshot_sheets, write_raw_snapshot
from ledgerloom.sources.store import CoreStore, PublicationConflict


@pytest.fixture(scope="module")
def text_sheets(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    line = "{n},{code},Widget,{q},2011-01-0{d} 08:00:00,2.5,12345.0,UK\n"
    one = [line.format(n=i, code=f" {10000 + i}a", q=i % 5 + 1, d=1) for i in range(50)]
    two = one[:7] + [line.format(n=f"C{i}", code="post", q=-1, d=2) for i in range(20)]
    paths = {}
    for name, lines in (("first", one), ("second", two)):
        path = folder / f"{name}.csv"
        path.write_text(head + "".join(lines))
        paths[name] = str(path)
    return paths


def test_text_pipeline_end_to_end_and_snapshot_reuse(spark, text_sheets, tmp_path):
    run = run_clean(spark, text_sheets, str(tmp_path), text=True)
    summary = run.summary.first()
    assert (summary["raw_rows"], summary["rows_retained"], summary["cross_sheet_duplicates_removed"]) == (77, 70, 7)
    assert run.validation["is_valid"] and not run.reused_snapshot
    assert run_clean(spark, text_sheets, str(tmp_path), text=True).reused_snapshot


def test_snapshot_keeps_source_order_across_files(spark, text_sheets, tmp_path):
    path = str(tmp_path / "raw")
    write_raw_snapshot(refuse_broken_records(read_text_sheets(spark, text_sheets)), path, TEXT_POSITION)
    again = read_sheets(spark, snapshot_sheets(path, list(text_sheets)), snapshot=True)
    invoices = [r[0] for r in again.orderBy("source_order").select("Invoice").collect()]
    assert invoices == [str(i) for i in range(50)] + [str(i) for i in range(7)] + [f"C{i}" for i in range(20)]


def test_fingerprint_ignores_order_and_sees_one_changed_cell(spark, text_sheets):
    ledger = read_text_sheets(spark, text_sheets)
    print_ = ledger_fingerprint(ledger).first()
    assert ledger_fingerprint(ledger.repartition(5, "StockCode")).first() == print_
    changed = ledger.withColumn("Price", F.when(F.col("Invoice") == "3", "2.51").otherwise(F.col("Price")))
    assert ledger_fingerprint(changed).first()["sha256"] != print_["sha256"]


def test_fingerprint_sees_every_cell_and_no_two_rows_alike(spark, ledger):
    def print_of(*rows):
        return ledger_fingerprint(ledger(*rows).withColumn("source_sheet", F.lit("s"))).first()["sha256"]

    pairs = [
        ({"Invoice": "1|2", "StockCode": "3"}, {"Invoice": "1", "StockCode": "2|3"}),  # a border that moved
        ({"Price": "2.0000001"}, {"Price": "2.0000002"}),
        ({"Quantity": "abc"}, {"Quantity": "abd"}),  # both unreadable
        ({"Quantity": "abc"}, {"Quantity": None}),
        ({"Description": None}, {"Description": "null"}),
        ({"InvoiceDate": "2011-01-01 10:00:00.000001"}, {"InvoiceDate": "2011-01-01 10:00:00.000002"}),
    ]
    for one, other in pairs:
        assert print_of(one) != print_of(other)
        left, right = (ledger_tree(ledger(x, {"Invoice": "9"}).withColumn("source_sheet", F.lit("s"))) for x in (one, other))
        assert 1 <= differing_leaves(left, right, ["source_sheet", "bucket"]).count() <= 2
    assert print_of({"Price": "2.50", "Quantity": "1.0", "InvoiceDate": "2011-01-01"}) == print_of({"Price": "2.5", "InvoiceDate": "2011-01-01 00:00:00"})


def test_text_positions_do_not_depend_on_the_splits(spark, tmp_path):
    folder = tmp_path / "wide"
    folder.mkdir()
    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    for part in range(2):
        (folder / f"part-{part}.csv").write_text(head + "".join(f"{part}x{i},1,{'w' * (i % 90)},1,2011-01-01,1,1,UK\n" for i in range(400)))
    found = []
    for size in ("128m", "3k", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            arrived = refuse_broken_records(read_text_sheets(spark, {"s": str(folder)}))
            found.append((arrival_fingerprint(arrived, TEXT_POSITION).first()["sha256"], {r.Invoice: r._ordinal for r in arrived.collect()}))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2]
    assert found[0][1] == {f"{part}x{i}": i for part in range(2) for i in range(400)}


def test_line_breaks_in_quotes_are_refused_or_read(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(
        'Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n1,A,"two\nlines",1,2011-01-01,1,1,UK\n2,B,"a, b",1,2011-01-01,1,1,UK\n'
    )
    with pytest.raises(ValueError, match="cells: 2"):
        refuse_broken_records(read_text_sheets(spark, {"s": str(path)}))
    whole = refuse_broken_records(read_text_sheets(spark, {"s": str(path)}, multi_line=True))
    assert sorted((r.Invoice, r.Description, r._ordinal) for r in whole.collect()) == [("1", "two\nlines", 0), ("2", "a, b", 1)]
    with pytest.raises(ValueError, match="line breaks"):
        run_clean(spark, {"s": str(path)}, str(tmp_path / "out"), text=True)
    assert run_clean(spark, {"s": str(path)}, str(tmp_path / "out"), text=True, multi_line=True).summary.first()["raw_rows"] == 2


def test_source_files_have_names_sizes_and_times(spark, text_sheets):
    import pathlib

    rows = {r["source_sheet"]: r for r in source_files(spark, text_sheets).collect()}
    for name, path in text_sheets.items():
        files = [p for p in ([pathlib.Path(path)] if pathlib.Path(path).is_file() else pathlib.Path(path).glob("*.csv"))]
        assert rows[name]["bytes"] in {f.stat().st_size for f in files} and rows[name]["changed_at"] is not None


def test_arrival_fingerprint_sees_order_and_damage(spark, tmp_path):
    def arrived(name, lines):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / "x.csv").write_text("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n" + "\n".join(lines))
        return arrival_fingerprint(refuse_broken_records(read_text_sheets(spark, {"s": str(tmp_path / name)})), TEXT_POSITION).first()["sha256"]

    rows = ["1,A,x,?5,2011-01-01,1,1,UK", "2,B,y|z,2,2011-01-01,1.0000001,1,UK"]
    first = arrived("a", rows)
    assert arrived("a", rows) == first
    assert arrived("a", rows[::-1]) != first
    assert arrived("a", [rows[0].replace("?5", "abc"), rows[1]]) != first
    assert arrived("a", [rows[0], rows[1].replace("1.0000001", "1.0000002")]) != first


def test_many_sheets_keep_their_order_and_misfits_are_errors(spark):
    frames = [spark.range(2).select(sheet_position(i, F.lit(3), F.col("id")).alias("p")).collect() for i in (0, 31, 32, 33, 4095)]
    places = [r["p"] for rows in frames for r in rows]
    assert places == sorted(places) and len(set(places)) == len(places) and places[0] >= 0
    with pytest.raises(ValueError):
        sheet_position(4096, F.lit(0), F.lit(0))
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(sheet_position(0, F.lit(1 << 22), F.col("id"))).collect()


def test_digest_sums_do_not_overflow(spark):
    total = spark.range(3).select(F.lit("9" + "0" * 25).cast("decimal(28,0)").alias("d")).agg(F.sum("d")).first()[0]
    assert int(total) == 27 * 10**25


def test_publish_replaces_one_namespace_atomically(spark, house, tmp_path):
    store = CoreStore(spark, str(tmp_path))
    core = house.core()
    assert store.table("customers").count() == 0
    first = store.publish(core, "LEDGER")
    other = {t: f.limit(3).withColumn("source_system", F.lit("OTHER")) for t, f in core.items()}
    store.publish(other, "OTHER")
    fewer = {t: f.limit(2) for t, f in core.items()}
    with pytest.raises(RuntimeError):
        store.publish(fewer, "LEDGER", fail_after="write")
    assert store.table("invoice_lines").where("source_system = 'LEDGER'").count() == first["invoice_lines"]
    store.publish(fewer, "LEDGER")
    counts = {r[0]: r[1] for r in store.table("invoice_lines").groupBy("source_system").count().collect()}
    assert counts == {"LEDGER": 2, "OTHER": 3}


def _some(core, n, system="LEDGER"):
    return {t: f.limit(n).withColumn("source_system", F.lit(system)) for t, f in core.items()}


def test_two_publishers_from_one_version_do_not_mix(spark, house, tmp_path):
    core, store, other = house.core(), CoreStore(spark, str(tmp_path)), CoreStore(spark, str(tmp_path))
    store.publish(_some(core, 1), "A/b")
    start = store.current()["A/b"]
    other.publish(_some(core, 2), "A/b", parent=start)
    with pytest.raises(PublicationConflict):
        store.publish(_some(core, 3), "A/b", parent=start)
    assert store.table("customers").count() == 2
    # a writer whose record another one had already taken the number of
    created = store._create
    store._create = lambda path, text: (other.publish(_some(core, 4), "A/b"), created(path, text))[1]
    with pytest.raises(PublicationConflict):
        store.publish(_some(core, 5), "A/b")
    del store._create
    assert {store.table(t).count() for t in ("customers", "invoice_lines")} == {4}


def test_a_dead_writer_blocks_nobody_and_is_cleaned_up(spark, house, tmp_path):
    core, store = house.core(), CoreStore(spark, str(tmp_path))
    store.publish(_some(core, 1), "LEDGER")
    (tmp_path / "log" / "LEDGER" / "2.json").write_text('{"source_system": "LEDGER", "version": 2, "par')  # cut short
    with pytest.raises(RuntimeError):
        store.publish(_some(core, 3), "LEDGER", fail_after="write")
    store.publish(_some(core, 2), "LEDGER")
    assert store.current() == {"LEDGER": 3} and store.table("products").count() == 2
    assert store.clean_up(older_than=3600) == []
    assert len(store.clean_up(older_than=0)) == 2 and store.table("products").count() == 2


def test_digest_sums_are_whole_beyond_longs(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from ledgerloom.sources.fingerprint import digest_leaves

    digests = ["f" * 64] * 40 + ["0" * 14 + "1" + "8" * 49] * 3
    rows = spark.createDataFrame([(i % 2, d) for i, d in enumerate(digests)], "k int, d string")
    got = {r["k"]: (r["rows"], r["digest_a"], r["digest_b"]) for r in digest_leaves(rows, F.col("d"), {"k": F.col("k")}).collect()}
    want = {}
    for k in (0, 1):
        own = [d for i, d in enumerate(digests) if i % 2 == k]
        want[k] = (len(own), Decimal(sum(int(d[:15], 16) for d in own)), Decimal(sum(int(d[15:30], 16) for d in own)))
    assert got == want and want[0][1] > 2**63
    plan = digest_leaves(rows, F.col("d"), {"k": F.col("k")})._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and not any("partial_sum(cast" in line and "decimal" in line for line in plan.splitlines())


def test_strip_leaves_no_white_space(spark):
    from pyspark.sql import functions as F

    from ledgerloom.functions.expressions import WHITESPACE, strip

    texts = [None, "", " ", "a", " a", "a ", "a b", "!~", "~ ", "\u00e9", "\u00a0x\u3000", "x\u2003", "\x1fx", "\x7fx\x7f", "\U0001f600 ", "\x85!"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s"))
    assert {r["t"]: r["s"] for r in frame.collect()} == {t: None if t is None else t.strip(WHITESPACE) for t in texts}
    spared = frame.select("s")._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in spared  # cells with bare ends are not trimmed


def test_snapshot_of_known_size_is_not_counted(spark, tmp_path, monkeypatch):
    ledger = spark.range(40).selectExpr("cast(id as string) AS Invoice", "if(id % 2 = 0, 'a', 'b') AS source_sheet", "-id AS place")

    def count(_):
        raise AssertionError("counted")

    monkeypatch.setattr(type(ledger), "count", count)
    write_raw_snapshot(ledger, str(tmp_path / "raw"), ["place"], rows=40)
    monkeypatch.undo()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 40
