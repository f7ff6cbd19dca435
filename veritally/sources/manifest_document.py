"""A manifest that is one JSON document, read and written by many tasks.

``{"defects": {"<defect>": {"rule": "<rule>", "keys": ["<key>", ...]}, ...}, ...}``, with other fields
and any white space. The text is cut at quotation marks wherever a block of the file begins and
ends. Whether a piece lies inside a string, how deep it is nested and which field it belongs to
follow from running sums over the pieces: of quotation marks, of brackets and of colons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritally.operators.frames import aggregate
from veritally.session import written
from veritally.sources.numbering import placed, running

# Where things stand in the document, by the number of open brackets.
TOP, DEFECT, FIELD, KEY = 1, 2, 3, 4

# A piece that ends with an odd number of backslashes is followed by a quotation mark of the string's own.
ESCAPED = r"length(regexp_extract(value, r'(\\*)\z', 1)) % 2 = 1"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(value, quote, depth, field): pieces between quotation marks, and how many quotation marks that
    open or close a string, open brackets and colons stand before them."""
    cut = written(placed(spark.read.option("lineSep", '"').text(path)))
    quoted = written(running(cut, quote=f"IF({ESCAPED}, 0, 1)"))
    outside = "quote % 2 = 0"
    depth = ("length(regexp_replace(value, r'[^\\[{]', '')) - length(regexp_replace(value, r'[^\\]}]', ''))")
    return running(quoted, depth=f"IF({outside}, {depth}, 0)", field=f"IF({outside} AND value RLIKE r'^\\s*:', 1, 0)")


def _strings(pieces: DataFrame) -> DataFrame:
    """(quote, depth, field, text): the strings, those with quotation marks of their own put together."""
    inside = pieces.where("quote % 2 = 1")
    parts = aggregate(inside, ["quote", "depth", "field"], "array_sort(collect_list(struct(_start, _task_row, value))) AS parts")
    json = "concat('[\"', array_join(transform(parts, x -> x.value), '\"'), '\"]')"
    return parts.selectExpr("quote", "depth", "field", f"from_json({json}, 'array<string>')[0] AS text")


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document with the keys of every defect -> (defect_id, rule_id, key)."""
    pieces = written(_pieces(spark, path))
    strings = written(_strings(pieces))
    colons = pieces.where(r"quote % 2 = 0 AND value RLIKE r'^\s*:'").selectExpr("quote - 1 AS quote", "field + 1 AS field")
    # A row per field of the document; keys are no fields.
    names = colons.join(strings.select("quote", "depth", "text"), "quote")
    before = "OVER (ORDER BY field ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fields = written(names.selectExpr(
        "field", "depth", "text AS name", f"last_value(IF(depth = {TOP}, text, NULL), true) {before} AS top",
        f"last_value(IF(depth = {DEFECT}, text, NULL), true) {before} AS defect_id"))
    own = fields.where(f"depth = {FIELD} AND top = 'defects'").select("field", "name", "defect_id")
    # The value of a field is the first string after its colon.
    values = strings.where(f"depth = {FIELD}").join(own.where("name = 'rule'"), "field")
    rules = aggregate(values, ["defect_id"], "min_by(text, quote) AS rule_id")
    keys = strings.where(f"depth = {KEY}").join(own.where("name = 'keys'"), "field").selectExpr("defect_id", "text AS key")
    return keys.join(rules, "defect_id", "left").select("defect_id", "rule_id", "key")


def write_manifest_document(manifest: DataFrame, path: str) -> None:
    """(defect_id, rule_id, key) as one document in one file, a key a line: the last step is one
    task, as one file is, and holds a line at a time."""
    each = "(PARTITION BY defect_id ORDER BY key)"
    place = manifest.selectExpr("*", f"row_number() OVER {each} = 1 AS is_first", f"lead(key) OVER {each} IS NULL AS is_last")
    text = "regexp_extract(to_json(struct({0} AS x), map('ignoreNullFields', 'false')), r'^\\{{\"x\":(.*)\\}}$', 1)".format
    head = f"concat({text('defect_id')}, ': {{\"rule\": ', {text('rule_id')}, ', \"keys\": [')"
    line = f"concat(IF(is_first, {head}, ''), {text('key')}, IF(is_last, ']}}', ','))"
    lines = place.selectExpr("defect_id", "key", "1 AS part", f"{line} AS value", "is_last")
    last = aggregate(lines, [], "max(defect_id) AS d").scalar()
    body = lines.withColumn("d", last).selectExpr("part", "defect_id", "key", "IF(is_last AND defect_id <> d, concat(value, ','), value) AS value")
    ends = manifest.sparkSession.sql("SELECT * FROM VALUES (0, '{\"defects\": {'), (2, '}}') t(part, value)").selectExpr(
        "part", "CAST(NULL AS STRING) AS defect_id", "CAST(NULL AS STRING) AS key", "value")
    whole = body.unionByName(ends).repartition(1).sortWithinPartitions("part", "defect_id", "key")
    whole.select("value").write.mode("overwrite").text(path)
