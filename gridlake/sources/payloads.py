"""From nested JSON documents to typed rows.

Every reader can keep a mark of documents that could not be read. Such a document gives one row without values, in
place of its rows, with the reason and its text in the column `bad`; nothing is dropped unseen, and a document is
parsed once for its rows and its mark. An item of a good document that has no list of rows is marked in the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlake.functions.scalar import as_column, strip, to_number, unnest

MAP = "map<string,string>"
CORRUPT = "_corrupt"


def marked(reason: Column, text: Column) -> Column:
    """NULL for a good document, else why it could not be read, and its text."""
    return F.when(reason.isNotNull(), F.struct(reason.alias("reason"), text.alias("text")))


def unreadable(json: Column, failed: Column, shapeless: Column) -> Column:
    """The reason, if any: `failed` when the parser met a fault, `shapeless` when what a reader needs is not there.

    A fault in a text that is JSON is a field of another type; that field alone is missing. The text is parsed a
    second time only for documents with a fault. The parser stops at the end of the first object, so what an object
    ends in is looked at as well.
    """
    bare = strip(json)
    return (
        F.when(json.isNull(), "no document")
        .when(bare == "", "empty document")
        .when((failed & F.try_parse_json(json).isNull()) | (bare.startswith("{") & ~bare.endswith("}")), "not JSON")
        .when(shapeless, "unexpected shape")
    )


def parse(df: DataFrame, json: str, schema: StructType, bad: str | None = None, must: list[str] | None = None) -> DataFrame:
    """Replace a JSON text column by its declared fields; undeclared fields are ignored, absent ones NULL.

    `bad` names a column for the mark of documents that are no JSON (cut short, another format) or lack one of the
    fields `must` (all top fields, if not given). Their fields are NULL.
    """
    rest = [c for c in df.columns if c != json]
    if bad is None:
        return df.withColumn("_doc", F.from_json(json, schema)).select(*rest, "_doc.*")
    checked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = df.withColumn("_doc", F.from_json(json, checked, {"columnNameOfCorruptRecord": CORRUPT}))
    needed = [F.col(f"_doc.{f}").isNull() for f in (must or schema.fieldNames())]
    reason = unreadable(F.col(json), F.col(f"_doc.{CORRUPT}").isNotNull(), reduce(Column.__or__, needed))
    whole = parsed.select(*rest, "_doc", marked(reason, F.col(json)).alias(bad))
    good = F.col(bad).isNull()
    return whole.select(*rest, bad, *[F.when(good, F.col(f"_doc.{f}")).alias(f) for f in schema.fieldNames()])


def _mark_items(df: DataFrame, bad: str | None, item: str, rows: Column) -> DataFrame:
    """Mark an item of a document that has no list of rows where it should have one."""
    if bad is None:
        return df
    broken = F.col(item).isNotNull() & rows.isNull()
    return df.withColumn(bad, F.coalesce(bad, marked(F.when(broken, "unexpected shape"), F.to_json(item))))


def _kept(keep: list[str] | None, bad: str | None) -> tuple[list[str], Column | None]:
    return [*(keep or []), *([bad] if bad else [])], F.col(bad).isNotNull() if bad else None


def flatten_blocks(
    df: DataFrame, blocks: str, values: str, tag: str, keep: list[str] | None = None, position: str | None = None,
    bad: str | None = None,
) -> DataFrame:
    """One row per value of each nested block, with the block's tag.

    `position`, here and below, names a column that orders the rows of one document; `bad` the mark that `parse`
    made, whose documents give one row each.
    """
    keep, also = _kept(keep, bad)
    rows = F.col("_block").getField(values)
    per_block = _mark_items(unnest(df, keep, blocks, "_b", "_block", also), bad, "_block", rows)
    block_tag = F.col("_block").getField(tag).alias(tag)
    per_value = unnest(per_block, [*keep, "_b", block_tag], rows, "_v", "_value", also)
    order = [F.struct("_b", "_v").alias(position)] if position else []
    return per_value.select(*keep, *order, tag, "_value.*")


def flatten_prices(
    df: DataFrame, json: str, ts: str = "start_date", price: str = "price", other: str = "value",
    keep: list[str] | None = None, position: str | None = None, bad: str | None = None,
) -> DataFrame:
    """Points of a payload that holds blocks with nested `values`, points already flat, or both.

    Only the first field of the document is read. The other field serves when the price *key* is absent;
    a price that is present but null stays null, so points are read as maps. `bad` names a column for the mark of
    documents that are no JSON or whose first field is no list; they give one row each.
    """
    first_field = F.get(F.map_values(F.from_json(json, MAP)), F.lit(0))
    listed = df.withColumn("_items", F.from_json(first_field, f"array<{MAP}>"))
    if bad:
        missing = F.col("_items").isNull()
        listed = listed.withColumn(bad, marked(unreadable(F.col(json), missing, missing), F.col(json)))
    keep, also = _kept(keep, bad)
    nested = F.from_json(F.element_at("_item", F.lit("values")), f"array<{MAP}>")
    points = F.when(F.map_contains_key("_item", "values"), nested).otherwise(F.array("_item"))
    items = unnest(listed, keep, "_items", "_b", "_item", also).withColumn("_points", points)
    items = _mark_items(items, bad, "_item", F.col("_points"))
    per_point = unnest(items, [*keep, "_b"], "_points", "_v", "_point", also)

    chosen = F.when(F.map_contains_key("_point", price), F.element_at("_point", F.lit(price))).otherwise(
        F.element_at("_point", F.lit(other))
    )
    order = [F.struct("_b", "_v").alias(position)] if position else []
    return per_point.select(
        *keep, *order, F.element_at("_point", F.lit(ts)).alias(ts), to_number(chosen).alias(price)
    )


def zip_arrays(
    df: DataFrame, arrays: dict[str, Column | str], tags: list[str], position: str | None = None, bad: str | None = None
) -> DataFrame:
    """Rows from parallel arrays, cut to the shortest; `tags` are columns repeated on every row."""
    tags, also = _kept(tags, bad)
    cols = {name: as_column(c) for name, c in arrays.items()}
    shortest = F.array_min(F.array(*[F.size(c) for c in cols.values()]))
    cut = [F.slice(c, F.lit(1), F.greatest(shortest, F.lit(0))).alias(name) for name, c in cols.items()]
    rows = unnest(df, tags, F.arrays_zip(*cut), position or "_pos", "_row", also)
    return rows.select(*tags, *([position] if position else []), "_row.*")


def records_to_rows(
    df: DataFrame, records: str, mapping: dict[str, str], keep: list[str] | None = None, position: str | None = None,
    bad: str | None = None,
) -> DataFrame:
    """One row per record, fields renamed; a field the record does not have is NULL."""
    keep, also = _kept(keep, bad)
    rows = unnest(df, keep, records, position or "_pos", "_r", also)
    return rows.select(
        *keep,
        *([position] if position else []),
        *[F.col("_r").getField(field).alias(name) for field, name in mapping.items()],
    )


def split_bad(rows: DataFrame, bad: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of good documents, and one row per bad document: `keep`, reason and text."""
    good = rows.filter(F.col(bad).isNull()).drop(bad)
    return good, rows.filter(F.col(bad).isNotNull()).select(*keep, f"{bad}.reason", f"{bad}.text")
