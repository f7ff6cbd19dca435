"""The full quality run: findings, scores, expectations, pipeline, checks, written by section."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.config import Config, Runs
from veritally.functions.expressions import quoted
from veritally.operators.frames import aggregate
from veritally.plans import expectations, rules, score
from veritally.plans.pipeline import Pipeline
from veritally.plans.reconcile import Checks, Source
from veritally.session import side_by_side
from veritally.sources.extract import COLUMNS, Extract
from veritally.sources.sinks import read_section, write_sections, written_table as _written_table


def counts(raw: Extract) -> DataFrame:
    """Rows per table, as the manifest lists them."""
    return rules.table_counts(raw, [name for name in COLUMNS if name != "closing_balances"])


def quarantine_breakdown(quarantine: DataFrame) -> DataFrame:
    return aggregate(quarantine, ["reject_reason"], "count(*) AS rows")


# Sections of the report, and what orders the entries of a list.
LISTED = {
    "counts": "table", "dimensions": "dimension", "rules": "rule_id", "grading": "rule_id", "daily": "date",
    "expectations": "suite, column, expectation", "reconciliation": "check_id", "mismatches": "check_id, issue, place",
    "quarantine": "reject_reason",
}


def document(sections: Mapping[str, DataFrame]) -> DataFrame:
    """The report as one row with one JSON text: single values first, then the sections as ordered lists.

    A section has a row per rule, day, check or reason, ten samples a check at most: bounded by the
    extract's definition and period, not by its rows.
    """
    parts = [sections["run"].select(c).scalar().alias(c) for c in ("as_of", "pipeline_faults", "report_rows")]
    parts.append(sections["score"].select("score").scalar().alias("score"))
    for name, order in LISTED.items():
        rows = sections[name]
        columns = ", ".join(f"CAST(`{c}` AS STRING) AS `{c}`" if kind == "date" else f"`{c}`" for c, kind in rows.dtypes)
        entries = aggregate(rows, [], f"transform(array_sort(collect_list(struct(struct({order}) AS place, struct({columns}) AS entry))), x -> x.entry) AS entries")
        parts.append(entries.scalar().alias(name))
    one = sections["run"].sparkSession.range(1)
    return one.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("document"))


def build_report(
    raw: Extract, manifest: DataFrame, cfg: Config, folder: str, faults: Iterable[str] = (), delivery: str | None = None
) -> dict[str, DataFrame]:
    """Write stages under ``folder/tables`` and sections under ``folder/report``; return the sections.

    The raw text, the marked copies, findings, the pipeline's tables, the recomputed sides of the
    checks and the ids that differ are written once and read back, so is every section, and at last all sections as one
    JSON document: a lost executor costs only its own tasks. What does not depend on each other is written side by side.
    Every table is versioned: a rerun that dies leaves the last report readable. ``folder`` must be one every executor can reach; all that is written lies in it.

    ``delivery`` names the extract and its manifest. With it a rerun resumes: tables that were written for the same
    delivery, settings and faults are read, the others are written. Give a new name to changed data.
    """
    tables, faults = f"{folder}/tables", sorted(faults)
    label = None if delivery is None else f"{delivery} {cfg} {faults}"

    def written_table(rows: DataFrame, path: str, *how) -> DataFrame:
        return _written_table(rows, path, *how, label=label)

    def write(*stage: tuple) -> list[DataFrame]:
        """Tables that do not depend on each other, each given as rows, name and layout."""
        return side_by_side(spark, [lambda rows=rows, name=name, how=how: written_table(rows, f"{tables}/{name}", *how)
                                    for rows, name, *how in stage])

    spark = raw.transactions.sparkSession
    written_raw = dict(zip(COLUMNS, write(*[(getattr(raw, t), f"raw_{t}") for t in COLUMNS])))
    raw = Extract(**{t: lambda t=t: written_raw[t] for t in COLUMNS})
    out, source = Pipeline(raw, cfg, Runs.single(faults)), Source(raw, cfg)
    checks = Checks(source, out)
    source.valid, out.known_again = write((source.valid, "valid_transactions"), (out.ids_again(), "repeated_ids"))
    source.balances, out.checked, source.reasons = write(
        (source.balances, "expected_balances"), (out.checked, "checked_transactions"), (source.reasons, "expected_reasons"))
    found, out.quarantine, out.staging = write(
        (rules.findings(raw, cfg, balances=source.balances), "findings"),
        (out.quarantine, "quarantine_transactions"), (out.staging, "stg_transactions"))
    out.daily, out.account_runs, by_rule, checks.id_issues = write(
        (out.daily, "rpt_daily_branch_summary", ("report_date", "branch_code"), "report_date"),
        (out.account_runs, "account_runs"), (score.rule_scores(raw, found), "rule_scores"), (checks.id_issues, "id_issues"))
    out.balances, = write((out.balances, "rpt_account_balances", ("account_id",)))
    by_dimension = score.dimension_scores(by_rule)
    ids = quoted(*faults)
    sections = {
        "run": aggregate(out.daily, [], "count(*) AS report_rows").selectExpr(
            f"'{cfg.as_of}' AS as_of", f"CAST(array({ids}) AS ARRAY<STRING>) AS pipeline_faults", "report_rows"),
        "counts": counts(raw).orderBy("table"),
        "score": score.overall_score(by_dimension),
        "dimensions": by_dimension.orderBy("dimension"),
        "rules": by_rule.orderBy("rule_id"),
        "grading": score.grade(found, manifest).orderBy("rule_id"),
        "daily": score.daily_scores(raw, found, cfg).orderBy("date"),
        "expectations": expectations.evaluate_all(raw, cfg).orderBy("suite", "column", "expectation"),
        "reconciliation": checks.results().drop("run").orderBy("check_id"),
        "mismatches": checks.samples().drop("run").orderBy("check_id", "issue", "place"),
        "quarantine": quarantine_breakdown(out.quarantine).orderBy("reject_reason"),
    }
    write_sections(sections, f"{folder}/report", label)
    read = {name: read_section(spark, f"{folder}/report", name) for name in sections}
    write_sections({"document": document(read)}, f"{folder}/report", label)
    return read | {"document": read_section(spark, f"{folder}/report", "document")}
