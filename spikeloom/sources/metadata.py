"""Recording metadata: escaped binary settings, well sections, and the fields of recordings and wells that follow from them.

Texts come as (path, value) rows and become (path, section, key, value) settings by files.ini_settings; values stay text. A binary
setting, `@Variant(...)`, is decoded to the text of an integer, a JSON list, or a JSON object with its type and bytes.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.functions import scalars

from . import files

#: Keys of times in seconds, keys of a well that are no metadata, and the marks of escaped bytes.
TIME_KEYS = ["selected_time", "started", "finished"]
INTERNAL_KEYS = ["id", "annotations", "annotations_raw", "annotation_size", "groupcolor"]
ESCAPES = {"0": 0, "t": 9, "n": 10, "r": 13}
#: Type codes of binary settings.
LONG, INT, LIST, COLOUR = 0x81, 0x02, 0x09, 0x43
_TOKEN = re.compile(r"\\x([0-9a-fA-F]{1,2})|\\(.)|(.)", re.DOTALL)
_VARIANT = re.compile(r"@Variant\((.*)\)", re.DOTALL)


def unescaped(text: str) -> bytes:
    """The bytes of an escaped text; an unknown escape stands for its character."""
    code = lambda m: int(m[1], 16) if m[1] else ESCAPES.get(m[2], ord(m[2])) if m[2] else ord(m[3])
    return bytes(code(m) & 255 for m in _TOKEN.finditer(text))


def variant(text: str | None) -> str | None:
    """A binary setting's value; other texts as they are."""
    m = _VARIANT.fullmatch(text or "")
    if not m:
        return text
    data = unescaped(m[1])
    number = lambda at, size, signed=True: int.from_bytes(data[at : at + size], "big", signed=signed)
    kind = number(0, 4, False) if len(data) >= 4 else None
    for code, size in ((LONG, 8), (INT, 4)):
        if kind == code and len(data) >= 4 + size:
            return str(number(4, size))
    if kind == LIST and len(data) >= 8:
        out, at = [], 8
        for _ in range(number(4, 4, False)):
            size = {INT: 4, LONG: 8}.get(number(at, 4, False)) if at + 4 <= len(data) else None
            if at + 4 > len(data):
                break
            if size is None or at + 4 + size > len(data):
                out.append({"_qt_variant_type": number(at, 4, False), "remaining_raw_hex": data[at + 4 :].hex()})
                break
            out.append(number(at + 4, size))
            at += 4 + size
        return json.dumps(out, separators=(",", ":"))
    return json.dumps({"_qt_variant_type": "QColor" if kind == COLOUR else kind, "raw_hex": data.hex()}, separators=(",", ":"))


def decoded(value: Column) -> Column:
    """`variant` for a column; only binary settings go through Python."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(variant, na_action="ignore")

    return F.when(value.startswith("@Variant("), F.pandas_udf(run, "string")(F.when(value.startswith("@Variant("), value))).otherwise(value)


def settings(texts: DataFrame) -> DataFrame:
    """(path, section, key, value) with binary settings decoded."""
    return files.ini_settings(texts).withColumn("value", decoded(F.trim("value")))


def wells(rows: DataFrame) -> DataFrame:
    r"""(path, well_id, well_name, fields, annotations) of the wells section of settings, whose keys are info\N\... for the N-th well.

    info\N\annotations\property\K\propertyName and ...\propertyValue are a pair; entries without an integer id are left out.
    """
    parts = F.split("key", r"\\")
    own = rows.where("section = 'wells'").select("path", parts.alias("k"), "value").where("size(k) >= 3 AND k[0] = 'info' AND k[1] RLIKE '^[0-9]+$'").withColumn("entry", F.expr("k[1]"))
    noted = F.expr("size(k) >= 5 AND k[2] = 'annotations' AND k[3] = 'property'")
    pairs = own.where(noted & F.expr("size(k) >= 6 AND k[4] RLIKE '^[0-9]+$'")).groupBy("path", "entry", F.expr("CAST(k[4] AS INT)").alias("n")).agg(F.max(F.expr("CASE WHEN k[5] = 'propertyName' THEN value END")).alias("name"), F.max(F.expr("CASE WHEN k[5] = 'propertyValue' THEN value END")).alias("value"))
    last = pairs.where("name <> ''").groupBy("path", "entry", "name").agg(F.max_by("value", "n").alias("value"))
    annotations = last.groupBy("path", "entry").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("annotations"))
    plain = own.where(~noted).withColumn("name", F.concat_ws("\\", F.expr("slice(k, 3, size(k) - 2)")))
    fields = plain.groupBy("path", "entry").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("fields"))
    columns = rows.where("section = 'wells' AND key = 'columns'").select("path", F.col("value").try_cast("int").alias("columns"))
    out = fields.withColumn("well_id", F.try_element_at("fields", F.lit("id")).try_cast("int")).where("well_id IS NOT NULL")
    out = out.join(annotations, ["path", "entry"], "left").join(columns, "path", "left")
    name = F.when(F.col("columns").isNotNull(), F.concat(F.char(65 + F.floor(F.col("well_id") / F.col("columns"))), (F.col("well_id") % F.col("columns") + 1).cast("string")))
    return out.select("path", "well_id", name.alias("well_name"), "fields", F.coalesce("annotations", F.expr("CAST(map() AS MAP<STRING, STRING>)")).alias("annotations"))


def well_metadata(found: DataFrame) -> DataFrame:
    """(path, well_id as wellNNN, metadata): a well's fields without internal ones; its annotations win."""
    inner = F.array(*map(F.lit, INTERNAL_KEYS))
    kept = F.map_filter("fields", lambda k, _: ~F.array_contains(inner, k))
    named = F.when(F.col("well_name").isNotNull(), F.create_map(F.lit("well_name"), F.col("well_name"))).otherwise(F.expr("CAST(map() AS MAP<STRING, STRING>)"))
    return found.select("path", scalars.padded_id("well", F.col("well_id")).alias("well_id"), merged(kept, merged(named, F.col("annotations"))).alias("metadata"))


def merged(old: Column, new: Column) -> Column:
    """Two maps as one; the new one's keys win."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)


def selected_wells(rows: DataFrame) -> DataFrame:
    """(path, well_id) of wells that are selected, by a list of numbers or a decoded list."""
    picked = rows.where("section = 'wells' AND key = 'selected'").select("path", F.explode(F.regexp_extract_all("value", F.lit(r"(\d+)"), F.lit(1))).alias("n"))
    return picked.select("path", F.col("n").cast("int").alias("well_id"))


def recording_fields(rows: DataFrame) -> DataFrame:
    """(path, key, value): properties and runtime as one, the runtime winning; times get an ISO form, and there is the runtime's length in seconds."""
    own = rows.where("section IN ('properties', 'runtime')").withColumn("late", F.col("section") == "runtime")
    seconds = F.col("value").try_cast("bigint")
    iso = own.where(F.col("key").isin(*TIME_KEYS)).select("path", F.concat("key", F.lit("_iso_utc")).alias("key"), F.regexp_replace(scalars.unix_iso(seconds), "Z$", "+00:00").alias("value"), "late").where("value IS NOT NULL")
    at = lambda k: F.max(F.when(F.col("key") == k, seconds))
    length = own.where("late").groupBy("path").agg((at("finished") - at("started")).cast("string").alias("value")).where("value IS NOT NULL").select("path", F.lit("actual_runtime_seconds").alias("key"), "value", F.lit(True).alias("late"))
    every = own.select("path", "key", "value", "late").unionByName(iso).unionByName(length)
    return every.groupBy("path", "key").agg(F.max_by("value", "late").alias("value"))


def extract(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(recording_fields, well_metadata of the selected wells, of all where none is selected)."""
    rows = settings(texts)
    found, chosen = wells(rows), selected_wells(rows)
    some = found.join(chosen, ["path", "well_id"], "left_semi").unionByName(found.join(chosen.select("path").distinct(), "path", "left_anti"))
    return recording_fields(rows), well_metadata(some)


def register_wells(known: DataFrame, recordings: DataFrame, incoming: DataFrame, create: bool = True) -> DataFrame:
    """known(cache_key, well_id, metadata) with incoming metadata merged in; wells that are new are added if `create`.

    A recording, or without `create` a well, that isn't known is a KeyError.
    """
    lost = incoming.join(recordings.select("cache_key"), "cache_key", "left_anti") if create else incoming.join(known.select("cache_key", "well_id"), ["cache_key", "well_id"], "left_anti")
    if found := lost.select("cache_key", "well_id").limit(5).collect():
        raise KeyError(f"not known: {[tuple(r) for r in found]}")
    none = F.expr("CAST(map() AS MAP<STRING, STRING>)")
    both = known.join(incoming.withColumnRenamed("metadata", "_new"), ["cache_key", "well_id"], "full")
    return both.select("cache_key", "well_id", merged(F.coalesce("metadata", none), F.coalesce("_new", none)).alias("metadata"))
