"""Sources and sinks, and the written report."""

import json
from dataclasses import replace

import pytest
from month import CFG, account, customer, extract, txn, write_csv
from pyspark.sql import functions as F

from veritally.config import Config
from veritally.plans import pipeline
from veritally.plans.report import build_report
from veritally.sources.extract import (
    COLUMNS, Extract, read_extract, read_manifest, write_extract, write_manifest)
from veritally.sources.manifest_document import read_manifest_document, write_manifest_document
from veritally.sources.sinks import VersionedTable, read_section


def test_every_column_is_text_and_empty_is_null(spark, tmp_path):
    people = [customer(email="", phone='quo"ted, comma')]
    raw = extract(spark, tmp_path, [txn(amount="-0.00", currency="")], [account()], people)
    assert {t for _, t in raw.transactions.dtypes} == {"string"}
    row, person = raw.transactions.first(), raw.customers.first()
    assert (row.amount, row.currency) == ("-0.00", None)
    assert (person.email, person.phone) == (None, 'quo"ted, comma')


def _turned(header, rows, order):
    return [header[i] for i in order], [[r[i] for i in order] for r in rows]


def test_columns_are_found_by_name(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn(), txn("T2", amount="7.00")])
    wanted = sorted(raw.transactions.collect())
    header, rows = COLUMNS["transactions"], [txn(), txn("T2", amount="7.00")]
    write_csv(tmp_path / "transactions.csv", *_turned(header, rows, range(len(header) - 1, -1, -1)))
    assert sorted(read_extract(spark, str(tmp_path)).transactions.collect()) == wanted
    write_csv(tmp_path / "transactions.csv", ["note", *header], [["x", *r] for r in rows])
    assert sorted(read_extract(spark, str(tmp_path)).transactions.collect()) == wanted
    write_csv(tmp_path / "transactions.csv", header[:-1], [r[:-1] for r in rows])
    with pytest.raises(ValueError, match="status"):
        read_extract(spark, str(tmp_path)).transactions  # noqa: B018


def test_files_with_other_headers_fail_or_are_sorted_out(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn(), txn("T2", amount="7.00")])
    wanted = sorted(raw.transactions.collect())
    (tmp_path / "transactions.csv").rename(tmp_path / "all.csv")
    folder = tmp_path / "transactions.csv"
    folder.mkdir()
    header = COLUMNS["transactions"]
    write_csv(folder / "1.csv", header, [txn()])
    write_csv(folder / "2.csv", *_turned(header, [txn("T2", amount="7.00")], [3, 0, 1, 2, 8, 7, 6, 5, 4]))
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, str(tmp_path)).transactions.collect()
    assert sorted(read_extract(spark, str(tmp_path), mixed_headers=True).transactions.collect()) == wanted


def test_absurd_values_are_shown_not_fatal(spark, tmp_path):
    from veritally.plans import expectations

    odd = ["99999999999999999999", "1e300", "Infinity", "-5"]
    rows = [txn(f"T{i}", amount=a) for i, a in enumerate(odd)] + [txn("T9", ts="9999-12-31T23:00:00Z")]
    results = {(r.expectation, r.column): r for r in expectations.evaluate(extract(spark, tmp_path, rows), "transactions", CFG).collect()}
    between = results[expectations.BETWEEN, "amount_num"]
    assert between.unexpected_count == 4 and None not in between.sample and "-5.00" in between.sample
    assert results[expectations.BETWEEN, "txn_ts_utc"].unexpected_count == 1


def test_extract_round_trip(spark, dirty, tmp_path):
    write_extract(dirty, str(tmp_path))
    again = read_extract(spark, str(tmp_path))
    for name in COLUMNS:
        before, after = getattr(dirty, name), getattr(again, name)
        assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty(), name


def test_manifest_in_both_forms(spark, manifest, planted_keys, tmp_path):
    write_manifest(manifest, str(tmp_path / "lines"))
    assert read_manifest(spark, str(tmp_path / "lines")).exceptAll(manifest).isEmpty()
    rule = {r.defect_id: r.rule_id for r in manifest.select("defect_id", "rule_id").distinct().collect()}
    document = {"seed": 1, "as_of": "2024-01-30", "counts": {"accounts": 1}, "defects": {
        d: {"rule": rule[d], "description": "", "keys": sorted(keys)} for d, keys in planted_keys.items()}}
    (tmp_path / "manifest.json").write_text(json.dumps(document, indent=2))
    flat = read_manifest_document(spark, str(tmp_path / "manifest.json"))
    assert flat.exceptAll(manifest).isEmpty() and manifest.exceptAll(flat).isEmpty()


def test_a_document_of_many_blocks(spark, tmp_path, small_splits):
    """Quotation marks, brackets, colons and line ends inside strings, fields in any order, blocks cut anywhere."""
    odd = ['a"b', "c\\", 'd\\"', "[{", "]}:", "x, y", "é\n\t", "", ":", '"', "\\\\\"", "defects", "keys"]
    document = {"defects_note": "\"keys\": [\"no\"]", "counts": {"keys": 3}, "list": [["a", ["b"]], {"keys": ["c"]}], "defects": {
        "DQ-01": {"keys": [f"T{i}" for i in range(2000)] + odd, "description": "later \"rule\": \"X\"", "rule": "UNQ-01"},
        "DQ \"2\"": {"rule": "CMP-01", "keys": odd + ["T1"]}, "DQ-03": {"rule": "VAL-01", "keys": []}, "DQ-04": {"keys": ["only"]}},
        "after": {"DQ-09": {"rule": "no", "keys": ["no"]}}}
    want = sorted((d, v.get("rule") or "", k) for d, v in document["defects"].items() for k in v["keys"])
    for i, text in enumerate((json.dumps(document), json.dumps(document, indent=3), json.dumps(document, separators=(",", ":"), ensure_ascii=False))):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
        got = read_manifest_document(spark, str(tmp_path / f"{i}.json"))
        assert sorted((r.defect_id, r.rule_id or "", r.key) for r in got.collect()) == want
        assert spark.read.option("lineSep", '"').text(str(tmp_path / f"{i}.json")).rdd.getNumPartitions() > 3
    written_as = spark.createDataFrame([w for w in want if w[1]], "defect_id string, rule_id string, key string")
    write_manifest_document(written_as, str(tmp_path / "out"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert {d: v["keys"] for d, v in json.loads(text)["defects"].items()} == {
        d: sorted(k for e, _, k in want if e == d) for d in ("DQ-01", 'DQ "2"')}
    assert sorted(tuple(r) for r in read_manifest_document(spark, str(tmp_path / "out")).collect()) == sorted(tuple(r) for r in written_as.collect())


def test_report_is_written_by_section(spark, dirty, manifest, cfg, tmp_path):
    sections = build_report(dirty, manifest, cfg, str(tmp_path))
    checks = read_section(spark, str(tmp_path / "report"), "reconciliation")
    assert checks.count() == 7 and checks.where("NOT passed").isEmpty()
    assert read_section(spark, str(tmp_path / "report"), "grading").where("precision < 1 OR recall < 1").isEmpty()
    assert sections["mismatches"].isEmpty()
    run = read_section(spark, str(tmp_path / "report"), "run").first()
    daily = VersionedTable(spark, str(tmp_path / "tables" / "rpt_daily_branch_summary")).read()
    assert run.report_rows == daily.count() > 0 and run.as_of == "2024-01-30"
    assert len(list((tmp_path / "tables" / "rpt_daily_branch_summary").glob("data-a/report_date=*"))) == 30


def test_the_document_holds_every_section(spark, dirty, manifest, cfg, tmp_path):
    sections = build_report(dirty, manifest, cfg, str(tmp_path), ["PIPE-01", "PIPE-04"])
    text = sections["document"].collect()
    assert len(text) == 1
    report = json.loads(text[0].document)
    assert report["as_of"] == "2024-01-30" and report["pipeline_faults"] == ["PIPE-01", "PIPE-04"]
    assert report["report_rows"] == sections["run"].first().report_rows
    assert report["score"] == sections["score"].first().score
    for name in ("counts", "dimensions", "rules", "grading", "daily", "expectations", "reconciliation", "mismatches", "quarantine"):
        rows = [{k: str(v) if k == "date" else v for k, v in r.asDict().items()} for r in sections[name].collect()]
        assert len(report[name]) == len(rows) and all(r in report[name] for r in rows), name
    assert [d["date"] for d in report["daily"]] == sorted(d["date"] for d in report["daily"])
    assert [r["rule_id"] for r in report["rules"]] == sorted(r["rule_id"] for r in report["rules"])


def test_a_rerun_resumes_where_the_last_one_died(spark, dirty, manifest, cfg, tmp_path):
    """The second run reads what the first wrote: its own extract would fail in every job."""
    lost = F.raise_error(F.lit("lost")).cast("string")
    dies = Extract(**{t: lambda t=t: getattr(dirty, t).withColumn(COLUMNS[t][0], lost) for t in COLUMNS})
    no_closing = Extract(**{**{t: lambda t=t: getattr(dirty, t) for t in COLUMNS}, "closing_balances": lambda: dies.closing_balances})
    with pytest.raises(Exception, match="lost"):
        build_report(no_closing, manifest, cfg, str(tmp_path), delivery="d1")
    transactions = VersionedTable(spark, str(tmp_path / "tables" / "raw_transactions"))
    assert transactions.version == 1
    first = build_report(dirty, manifest, cfg, str(tmp_path), delivery="d1")["document"].first().document
    assert transactions.version == 1 and VersionedTable(spark, str(tmp_path / "tables" / "raw_closing_balances")).version == 1
    assert build_report(dies, manifest, cfg, str(tmp_path), delivery="d1")["document"].first().document == first
    with pytest.raises(Exception, match="lost"):
        build_report(dies, manifest, cfg, str(tmp_path), delivery="d2")
    assert read_section(spark, str(tmp_path / "report"), "document").first().document == first


def _values(rows):
    return sorted(r.v for r in rows.collect())


def test_a_write_that_dies_leaves_the_last_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = spark.range(10).selectExpr("id AS v")
    dies = rows.selectExpr("IF(v = 7, raise_error('lost'), v) AS v").repartition(4)
    with pytest.raises(Exception, match="lost"):
        table.write(dies)
    assert table.version == 0
    for n in range(1, 6):
        assert _values(table.write(rows.selectExpr(f"v * {n} AS v"))) == [n * v for v in range(10)]
        with pytest.raises(Exception, match="lost"):
            table.write(dies)
        assert table.version == n and _values(table.read()) == [n * v for v in range(10)]
        assert sorted(p.name for p in (tmp_path / "t").iterdir() if "data" in p.name) in (["data-a"], ["data-a", "data-b"])
    # Killed between the data and its mark: the data of the other place is complete, but does not count.
    other = "data-a" if "data-b" in table.read().inputFiles()[0] else "data-b"
    rows.write.mode("overwrite").parquet(str(tmp_path / "t" / other))
    assert _values(table.read()) == [5 * v for v in range(10)]


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3).selectExpr("id AS v"))
    for _ in range(3):
        table.write(table.read().selectExpr("v + 1 AS v"))
    assert _values(table.read()) == [3, 4, 5] and table.version == 4


@pytest.fixture
def small_splits(spark):
    """Several blocks a file, several files and blocks a task."""
    settings = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "200"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_are_numbered_in_the_order_of_files_and_lines(spark, tmp_path, small_splits):
    extract(spark, tmp_path, [txn()])
    (tmp_path / "transactions.csv").unlink()
    (tmp_path / "transactions.csv").mkdir()
    # A third of the rows repeats one id; each copy says where it stands.
    lines = [("HOT" if i % 3 == 0 else f"T{i % 500}", i) for i in range(3000)]
    sizes = [700, 1, 0, 1299, 1000]
    for f, size in enumerate(sizes):
        start = sum(sizes[:f])
        write_csv(tmp_path / "transactions.csv" / f"part-{f:05d}.csv", COLUMNS["transactions"],
                  [txn(t, amount=f"{i + 1}.00", ts=f"2026-09-{28 - i % 20:02d}T06:00:00Z") for t, i in lines[start:start + size]])
    raw = read_extract(spark, str(tmp_path), row_number="src_row")
    rows = raw.transactions.selectExpr("txn_id", "src_row", "CAST(amount AS DECIMAL(18, 2)) AS amount").collect()
    assert sorted(r.src_row for r in rows) == list(range(1, 3001))
    assert all(r.src_row == r.amount for r in rows)
    cfg = replace(CFG, arrival="src_row")
    first = {}
    for t, i in lines:
        first.setdefault(t, i + 1)
    kept = pipeline.run(raw, cfg).classified.where("NOT is_copy").collect()
    assert {r.txn_id: r.src_row for r in kept} == first and len(kept) == len(first)
    # Without the number the earliest time would have won.
    assert any(r.amount != first["HOT"] for r in pipeline.run(raw, CFG).classified.where("NOT is_copy AND txn_id = 'HOT'").selectExpr(
        "CAST(amount AS DECIMAL(18, 2)) AS amount").collect())


def test_an_empty_table_has_no_numbers(spark, tmp_path):
    extract(spark, tmp_path, [])
    assert read_extract(spark, str(tmp_path), row_number="src_row").transactions.isEmpty()


def test_report_of_a_faulty_run_names_what_broke(spark, dirty, manifest, cfg, tmp_path):
    sections = build_report(dirty, manifest, cfg, str(tmp_path), ["PIPE-04"])
    failed = {r.check_id for r in sections["reconciliation"].where("NOT passed").collect()}
    assert failed == {"REC-01", "REC-02", "REC-04", "REC-05", "REC-06", "REC-07"}
    samples = sections["mismatches"].where("check_id = 'REC-02'").collect()
    assert 0 < len(samples) <= 5 and all(r.issue == "missing" and "txn_id=" in r.detail for r in samples)


def test_config_is_a_plain_value():
    assert Config() == Config() and Config().cutoff == "TIMESTAMP_NTZ'2026-09-30 18:30:00'"
