"""Readers of the raw formats, each to a frame of records.

All but ``sniff_separator`` (which looks at the first lines of one file) only declare
scans; parsing runs on the executors. ``conform`` casts to a fixed schema, so nothing
downstream depends on inference.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import unescape

#: Fields under which a JSON document may hold its records, in order.
RECORD_FIELDS = ("results", "items", "data", "diputados", "dataset", "rows")


def json_records(spark: SparkSession, path: str, schema: T.StructType | str, fields: tuple[str, ...] = RECORD_FIELDS) -> DataFrame:
    """Records of whole JSON documents of any form: the objects of an array; of the list
    under the first of ``fields`` that is one; else of the first list with an object in it,
    in the order of the document; else the document itself. A document that is no JSON
    fails the job; other values have no records."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = spark.read.text(path, wholetext=True).select(F.col("value").alias("doc")).withColumn("v", F.parse_json("doc"))
    is_list, is_object = (lambda v, n=n: F.coalesce(F.schema_of_variant(v).startswith(n), F.lit(False)) for n in ("ARRAY", "OBJECT"))
    objects = lambda v: F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: is_object(x))
    under = F.try_variant_get("v", "$", "map<string,variant>")
    entry = lambda k: F.try_element_at(under, k)
    lists = F.filter(F.json_object_keys("doc"), lambda k: is_list(entry(k)))
    named = F.filter(F.array(*[F.lit(f) for f in fields]), lambda k: F.array_contains(lists, k))
    filled = F.filter(lists, lambda k: F.size(objects(entry(k))) > 0)
    key = F.coalesce(F.get(named, F.lit(0)), F.get(filled, F.lit(0)))
    found = F.when(is_list(F.col("v")), objects(F.col("v"))).when(is_object(F.col("v")), F.when(key.isNull(), F.array("v")).otherwise(objects(entry(key))))
    return text.select(F.explode(found).alias("r")).select(F.from_json(F.to_json("r"), kind).alias("r")).select("r.*")


def numbered_lines(spark: SparkSession, path: str, number: str = "line_no") -> DataFrame:
    """file, block, value and the number of each line of text files, from 1. A file may be
    read in many tasks: a line's number is its place in its block and the lines of the
    blocks before, which are counted first. Values are the bytes of the file."""
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_at")]
    rows = spark.read.text(path).select("value", *meta)
    sizes = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("file", "block", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("_at"))
    return rows.withColumn("_in", inside).join(sizes, ["file", "block"]).select("file", "block", (F.col("_before") + F.col("_in")).alias(number), "value")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, line_no: str | None = None) -> DataFrame:
    """One record a line; malformed lines stay as rows with ``malformed`` set and the text
    in ``raw``; with ``line_no``, also the number of the line in its file."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    lines = (numbered_lines(spark, path, line_no) if line_no else spark.read.text(path)).filter(F.trim("value") != "")
    more = [line_no] if line_no else []
    return lines.select(F.col("value").alias("raw"), parsed.alias("r"), *more).select(*more, "raw", (F.col("r").isNull() | F.col("r._bad").isNotNull()).alias("malformed"), *[F.col(f"r.{f}") for f in kind.fieldNames()])


def _western(c: Column) -> Column:
    """Bytes in the Windows code page as text; the five bytes that it lacks are read as
    Latin-1."""
    pairs = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    return F.translate(F.decode(c.cast("binary"), "ISO-8859-1"), "".join(a for a, _ in pairs), "".join(b for _, b in pairs))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no and value of the lines of CSV files: a file that is no UTF-8 anywhere is
    read in the Windows code page; a byte order mark is left out."""
    lines = numbered_lines(spark, path)
    kinds = lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("_utf8"))
    text = F.when(F.col("_utf8"), F.col("value")).otherwise(_western(F.col("value")))
    marked = F.when(F.col("line_no") == 1, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    return lines.join(kinds, "file").select("file", "block", "line_no", text.alias("value")).withColumn("value", marked)


def csv_texts(lines: DataFrame, quote: str = '"') -> DataFrame:
    """file, line_no and value of the records of csv_lines. A line whose file has an odd
    number of quotes before it goes on with the record before: quotes are counted by blocks,
    summed up along the file, and only records of several lines are put together."""
    own = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    rows = lines.withColumn("_q", own)
    blocks = rows.groupBy("file", "block").agg(F.sum("_q").alias("_all"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_all").over(ahead), F.lit(0)).alias("_quotes"))
    inside = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(blocks, ["file", "block"]).withColumn("_open", (F.col("_quotes") + F.coalesce(F.sum("_q").over(inside), F.lit(0))) % 2 == 1)
    plain = rows.filter(~F.col("_open") & (F.col("_q") % 2 == 0)).select("file", "line_no", "value")
    # of the others, each first line begins a record that ends before the next one
    broken = rows.filter(F.col("_open") | (F.col("_q") % 2 == 1))
    first = F.max(F.when(~F.col("_open"), F.col("line_no"))).over(Window.partitionBy("file").orderBy("line_no"))
    parts = broken.withColumn("_first", first).groupBy("file", F.col("_first").alias("line_no")).agg(F.array_sort(F.collect_list(F.struct("line_no", "value"))).alias("p"))
    return plain.unionByName(parts.select("file", "line_no", F.array_join("p.value", "\n").alias("value")))


def _separator(head: list[str], choices: str = ";,\t|") -> tuple[str, bool]:
    """The separator of some first lines and whether a ``sep=`` line names it."""
    if head and head[0].strip().lower().startswith("sep=") and len(head[0].strip()) >= 5:
        return head[0].strip()[4], True
    score = lambda s: (min((line.count(s) for line in head), default=0), sum(line.count(s) for line in head))
    return max(choices, key=score), False


def sniff_separator(spark: SparkSession, path: str, choices: str = ";,\t|") -> tuple[str, bool]:
    """The separator of a CSV file and whether a ``sep=`` line names it, from its first lines."""
    return _separator([r.value.lstrip("\ufeff") for r in spark.read.text(path).limit(20).collect() if r.value.strip()], choices)


def csv_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str | None = None) -> DataFrame:
    """CSV files as agencies publish them: UTF-8 with or without a byte order mark or the
    Windows code page, a separator that a first line names or that is sniffed, line breaks
    inside quotes, blank rows dropped. All files have the header of the first one, whose first
    lines alone reach the driver; columns are texts unless a schema is given. A missing
    field is null. Files are read in as many tasks as they have blocks. Quotes are those
    around fields; a lone one inside an unquoted field would join lines."""
    import csv

    lines = csv_lines(spark, path)
    head = [r.value for r in lines.orderBy("file", "line_no").filter(F.trim("value") != "").limit(20).collect()]
    sniffed, named = _separator(head)
    sep = sep or sniffed
    if not head[int(named) :]:
        return spark.createDataFrame([], schema or "value string")
    names = [n.strip() for n in next(csv.reader(head[int(named) :], delimiter=sep))]
    kind = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema) if schema else T.StructType([T.StructField(n, T.StringType()) for n in names])
    # the header is the first line that is not blank, or the one after it
    filled = lines.filter(F.trim("value") != "")
    header = filled.groupBy("file").agg(F.min("line_no").alias("_header"))
    if named:
        header = filled.join(header, "file").filter(F.col("line_no") > F.col("_header")).groupBy("file").agg(F.min("line_no").alias("_header"))
    rows = csv_texts(lines).filter(F.trim("value") != "").join(header, "file").filter(F.col("line_no") > F.col("_header"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)
    parsed = rows.select(F.from_csv("value", ddl, {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("r")).select("r.*")
    blank = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`").cast("string")) == "") for c in parsed.columns])
    return parsed.filter(~blank)


def xml_records(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Elements of an XML file, names without their namespaces."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True)
    return (reader.schema(schema) if schema else reader).load(path)


def cube_series(cube: DataFrame, dims: list[str], sizes: list[int], values: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Long rows of a flat statistical cube: ``values`` maps a flat position to a value;
    each dimension's position is that of the row-major order of ``sizes``."""
    rows = cube.select(*keep, F.explode(values).alias("flat", "value")).withColumn("flat", F.col("flat").cast("long"))
    below = [reduce(lambda a, b: a * b, sizes[i + 1 :], 1) for i in range(len(sizes))]
    return rows.select(*keep, *[F.pmod(F.floor(F.col("flat") / n), F.lit(size)).alias(d) for d, size, n in zip(dims, sizes, below, strict=True)], "value")


def strip_html(c: str, entities: dict[str, str] | None = None, space: str = r"(?U)\s+") -> Column:
    """Text of a page: entities resolved first, so that escaped tags go too, then no
    scripts, styles, comments and tags, white space of any kind collapsed.

    All entities count, also without their semicolons as in HTML, or exactly those given,
    in that order; ``space`` is the pattern of what becomes one blank.
    """
    if entities is None:
        coded = F.contains(c, F.lit("&"))
        text = F.when(coded, unescape(F.when(coded, F.col(c)))).otherwise(F.col(c))
    else:
        text = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), entities.items(), F.col(c))
    text = F.regexp_replace(text, r"(?isu)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(text, space, " "))


def labelled_values(df: DataFrame, c: str) -> DataFrame:
    """df with label and value of each dt-dd pair of a page, plain text, in order."""
    pairs = F.regexp_extract_all(F.col(c), F.lit(r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>.*?</dd>"), F.lit(0))
    out = df.select("*", F.posexplode(pairs).alias("place", "_pair"))
    out = out.withColumns({"_label": F.regexp_extract("_pair", r"(?is)<dt[^>]*>(.*?)</dt>", 1), "_value": F.regexp_extract("_pair", r"(?is)<dd[^>]*>(.*?)</dd>", 1)})
    return out.withColumns({"label": strip_html("_label"), "value": strip_html("_value")}).drop("_pair", "_label", "_value")


def sections(df: DataFrame, c: str) -> DataFrame:
    """df with heading and body of each section of a page: a heading and what stands
    between it and the next one, plain text, in order."""
    parts = F.split(F.col(c), r"(?i)(?=<h[1-6][\s>])")
    out = df.select("*", F.posexplode(F.filter(parts, lambda p: p.rlike(r"(?i)^<h[1-6][\s>]"))).alias("place", "_part"))
    out = out.withColumns({"_head": F.regexp_extract("_part", r"(?is)^<h[1-6][^>]*>(.*?)</h[1-6]>", 1), "_body": F.regexp_replace("_part", r"(?is)^<h[1-6][^>]*>.*?</h[1-6]>", "")})
    return out.withColumns({"heading": strip_html("_head"), "body": strip_html("_body")}).drop("_part", "_head", "_body")


def refuse_html(df: DataFrame, column: str) -> DataFrame:
    """df, or a failing job where a payload is a web page instead of data."""
    bad = F.lower(F.ltrim(F.col(column))).rlike("^(<!doctype html|<html)")
    return df.filter(F.assert_true(~F.coalesce(bad, F.lit(False)), "a web page where data was expected").isNull())


def conform(df: DataFrame, schema: T.StructType | str, aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """df with exactly the fields of schema: the first alias that exists, cast without
    failing; what is missing is null."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)

    def field(f: T.StructField):
        names = [n for n in (f.name, *(aliases or {}).get(f.name, ())) if n in have]
        value = F.coalesce(*[F.col(f"`{n}`").cast("string") for n in names]) if len(names) > 1 else F.col(f"`{names[0]}`") if names else F.lit(None)
        return (value.try_cast(f.dataType) if names else value.cast(f.dataType)).alias(f.name)

    return df.select(*[field(f) for f in kind.fields])


def landed(df: DataFrame, payload: str, source: str) -> DataFrame:
    """Raw records with the source and a content hash as key, each payload once."""
    return df.withColumns({"source_id": F.lit(source), "content_sha256": F.sha2(F.col(payload), 256)}).dropDuplicates(["source_id", "content_sha256"])


def drop_private(df: DataFrame) -> DataFrame:
    """df without columns, nested fields and map keys whose names begin with an underscore,
    at any depth of structs, arrays and maps."""

    def clean(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            kept = F.struct(*[clean(c[f.name], f.dataType).alias(f.name) for f in kind.fields if not f.name.startswith("_")])
            return F.when(c.isNotNull(), kept)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: clean(x, kind.elementType))
        if isinstance(kind, T.MapType):
            own = F.map_filter(c, lambda k, _: ~k.startswith("_")) if isinstance(kind.keyType, T.StringType) else c
            return F.transform_values(own, lambda _, x: clean(x, kind.valueType))
        return c

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if not f.name.startswith("_")])


def workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, row and cells of the sheets of workbooks: shared strings resolved, gaps
    filled with null. A file is parsed in one task; the files are what is spread."""
    import io
    import re
    import zipfile
    from collections.abc import Iterator
    from xml.etree import ElementTree

    import pandas as pd

    def local(e: ElementTree.Element) -> str:
        return e.tag.rsplit("}", 1)[-1]

    def column_number(ref: str) -> int:
        n = 0
        for ch in re.match("[A-Z]+", ref).group():
            n = 26 * n + ord(ch) - 64
        return n - 1

    def cells(row: ElementTree.Element, shared: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for c in (e for e in row if local(e) == "c"):
            at = column_number(c.get("r", "A")) if c.get("r") else len(out)
            out += [None] * (at + 1 - len(out))
            text = "".join(t.text or "" for t in c.iter() if local(t) in ("v", "t"))
            out[at] = shared[int(text)] if c.get("t") == "s" and text else text or None
        return out

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                rows = []
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    shared = []
                    if "xl/sharedStrings.xml" in z.namelist():
                        shared = ["".join(t.text or "" for t in si.iter() if local(t) == "t") for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
                    for sheet in sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
                        table = (e for e in ElementTree.fromstring(z.read(sheet)).iter() if local(e) == "row")
                        rows += [(name, sheet.rsplit("/", 1)[-1][:-4], n, cells(r, shared)) for n, r in enumerate(table)]
                yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, "path string, sheet string, row long, cells array<string>")


def workbook_records(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, row and a map of header to cell: the header is the first row of a sheet
    with at least two cells that are not blank."""
    rows = workbook_rows(spark, path)
    filled = F.size(F.filter("cells", lambda c: c.isNotNull() & (F.trim(c) != "")))
    heads = rows.filter(filled >= 2).groupBy("path", "sheet").agg(F.min_by(F.struct("row", "cells"), "row").alias("head"))
    body = rows.join(heads, ["path", "sheet"]).filter((F.col("row") > F.col("head.row")) & (filled > 0))
    pairs = F.arrays_zip(F.transform("head.cells", lambda h: F.trim(h)).alias("h"), F.col("cells").alias("c"))
    named = F.filter(pairs, lambda p: p["h"].isNotNull() & (p["h"] != ""))
    return body.select("path", "sheet", "row", F.map_from_entries(F.transform(named, lambda p: F.struct(p["h"], p["c"]))).alias("record"))
