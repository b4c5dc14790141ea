"""Open records: fields that a declared schema does not know are kept.

The declared fields are typed columns as ever; all others of a JSON object go
into one column ``extra``, a map from name to VARIANT. Merging, nesting and
flattening carry that column along, and the writer puts its fields back on
the level they came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweek.operators.enrich import first_record, merge_right_wins
from tickweek.sinks.files import PACKED

EXTRA = "extra"


def extra_fields(text: Column | str, known: list[str], path: str = "$") -> Column:
    """The fields of the JSON object at ``path`` that are not ``known``; NULL where there is no object."""
    fields = F.try_variant_get(F.try_parse_json(text), path, "map<string,variant>")
    return F.map_filter(fields, lambda name, _: ~name.isin(known))


def open_documents(lines: DataFrame, schema: StructType) -> DataFrame:
    """JSON lines (``value``) as the columns of ``schema`` and ``extra``.

    A line that is no JSON object gives no row; a cell of another type is NULL."""
    known = [f.name for f in schema.fields]
    # Exploded, so each parse runs once per line: filters on projected parses are moved below them and parse again.
    parsed = lines.select(F.explode(F.array(F.struct(F.from_json("value", schema).alias("doc"), extra_fields("value", known).alias(EXTRA)))).alias("_line"))
    doc, extra = F.col("_line.doc"), F.col("_line").getField(EXTRA)
    return parsed.where(extra.isNotNull()).select(*[doc.getField(n).alias(n) for n in known], extra.alias(EXTRA))


def open_first_records(bodies: DataFrame, body: str, element: StructType, key: str = "symbol") -> DataFrame:
    """As ``first_record`` with the present fields, and ``extra`` of that record; the body is joined and grouped once."""
    known = [f.name for f in element.fields]
    records = first_record(bodies, body, element, key, present=True, text=EXTRA)
    return records.withColumn(EXTRA, extra_fields(EXTRA, known, "$[0]"))


def merge_open(left: DataFrame, right: DataFrame, key: str = "symbol") -> DataFrame:
    """``merge_right_wins`` for open records: of equal extra fields the right one stays, also when it is null."""
    own, other = "_extra_left", "_extra_right"
    merged = merge_right_wins(left.withColumnRenamed(EXTRA, own), right.withColumnRenamed(EXTRA, other), key)
    none = F.expr("map_from_arrays(cast(array() as array<string>), cast(array() as array<variant>))")
    a, b = F.coalesce(own, none), F.coalesce(other, none)
    both = F.map_concat(F.map_filter(a, lambda name, _: ~F.map_contains_key(b, name)), b)
    return merged.withColumn(EXTRA, both).drop(own, other)


def open_text(df: DataFrame, extra: str = EXTRA) -> Column:
    """One JSON object per row: the typed columns, NULL ones left out, then the extra fields."""
    typed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != extra]), {"ignoreNullFields": "true"})
    rest = F.when(F.size(F.col(extra)) > 0, F.to_json(F.col(extra)))

    def together(both: Column) -> Column:
        typed, rest = both["typed"], both["rest"]
        comma = F.when(typed == "{}", "").otherwise(",")
        text = F.concat(F.substring(typed, F.lit(1), F.length(typed) - 1), comma, F.substring(rest, F.lit(2), F.length(rest)))
        return F.coalesce(text, typed)

    # As the one element of an array, so that each text is made once however often it is named.
    return F.get(F.transform(F.array(F.struct(typed.alias("typed"), rest.alias("rest"))), together), F.lit(0))


def write_open_documents(df: DataFrame, path: str, mode: str = "overwrite", packed: bool = False) -> None:
    """Open records as JSON lines; extra fields stand beside the typed ones."""
    df.select(open_text(df).alias("value")).write.mode(mode).options(**(PACKED if packed else {})).text(path)
