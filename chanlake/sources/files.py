"""File sources and sinks.

Readers return lazy DataFrames and writers run on the executors; nothing
passes through the driver. Paths should live in a shared folder
(``session.shared_path``) on a cluster.
"""

from __future__ import annotations

import os
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlake.functions.text import WS_CLASS, strip_ws
from chanlake.session import shared_path
from chanlake.sources import csv_scan, json_scan

# CSV options for a lossless text round trip: '' stays '' and NULL stays NULL,
# padding is kept and embedded quotes/newlines survive.
CSV_WRITE = {"header": "true", "escape": '"', "nullValue": "\\N", "emptyValue": '""',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READ = {"header": "true", "escape": '"', "nullValue": "\\N", "emptyValue": "",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# --- S1 / S4 ---------------------------------------------------------------------

def odd_quotes(spark: SparkSession, path, delimiter: str = ",") -> bool:
    """Whether some line of the CSV files may leave a quoted field open: its quotes are odd in number, or one of them
    stands away from a field's edge. One distributed pass that stops at the first such line."""
    edge = re.escape(delimiter) + r'"\r'
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    away = F.col("value").rlike(f'[^{edge}]"[^{edge}]')
    return not spark.read.text(path).where(odd | away).limit(1).isEmpty()


def _csv_options(lossless: bool, delimiter: str) -> dict[str, str]:
    return (CSV_READ if lossless else {"header": "true", "escape": '"'}) | {"sep": delimiter}


def csv_records(spark: SparkSession, path, delimiter: str = ",") -> DataFrame | None:
    """(line, file, head) of the records of CSV files in which some record spans lines, written to the shared folder
    once; None where every line is a record, so that Spark's reader splits the files by itself."""
    if not odd_quotes(spark, path, delimiter):
        return None
    states = csv_scan.entries(spark, path, delimiter).collect()
    if not any(r["spans"] for r in states):                # only marks inside fields
        return None
    found = csv_scan.records(spark, path, delimiter, states)
    stored = shared_path(spark, "csv", "records")
    found.write.parquet(stored)
    return spark.read.schema(found.schema).parquet(stored)


def _header_of(records: DataFrame, options: dict[str, str]) -> list[str]:
    """Column names in the first file's header, read as Spark reads it."""
    head = records.where("head").orderBy("file").limit(1).select("line")
    names = _csv_texts(head, options | {"header": "false", "nullValue": ""}).first()
    return [n if n is not None else f"_c{i}" for i, n in enumerate(names)]


def _csv_texts(records: DataFrame, options: dict[str, str], infer: bool = False) -> DataFrame:
    """Spark's CSV reader over records that are rows already."""
    spark = records.sparkSession
    texts = getattr(records.select("line")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(**options).option("multiLine", "true").option("lineSep", "\n").option(
        "inferSchema", str(infer).lower())
    return DataFrame(reader._jreader.csv(texts), spark)


def _parse_csv(records: DataFrame, schema: T.StructType, options: dict[str, str], *more: str) -> DataFrame:
    """The fields of the records that are no headers."""
    kept = {k: v for k, v in options.items() if k != "header"} | {"multiLine": "true", "lineSep": "\n"}
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in nullable)
    return records.where("not head").select(F.from_csv("line", F.lit(ddl), kept).alias("r"), *more).select("r.*", *more)


def load_csv(spark: SparkSession, path: str, delimiter: str = ",", infer: bool = True,
             schema: T.StructType | str | None = None, lossless: bool = True,
             multi_line: bool | None = None) -> DataFrame:
    """Header row; types inferred (``infer``) or all strings; an explicit schema wins. Reads back what
    ``save_csv`` writes; ``lossless=False`` takes an empty field as NULL instead. Input splits replace the
    reference's chunked read, also where quoted fields hold line ends: records are then found by ``csv_scan``.
    ``multi_line`` forces one reading by Spark's own reader: True whole files, False a record a line."""
    options = _csv_options(lossless, delimiter)
    found = csv_records(spark, path, delimiter) if multi_line is None else None
    if found is None:
        r = spark.read.options(**options)
        r = r.option("multiLine", "true").option("lineSep", "\n") if multi_line else r
        return (r.schema(schema) if schema is not None else r.option("inferSchema", str(infer).lower())).csv(path)
    if schema is None:
        names = _header_of(found, options)
        typed = _csv_texts(found.where("not head"), options | {"header": "false"}, infer)
        schema = T.StructType([T.StructField(n, typed.schema[i].dataType if i < len(typed.columns) else T.StringType())
                               for i, n in enumerate(names)])
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return _parse_csv(found, schema, options)


def save_csv(df: DataFrame, path: str, delimiter: str = ",", lossless: bool = True) -> None:
    """Overwrite with a header; array/struct columns become JSON text."""
    w = _flat_columns(df).write.mode("overwrite").option("sep", delimiter)
    w = w.options(**CSV_WRITE) if lossless else w.option("header", "true")
    w.csv(path)


def _flat_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if _nested(df, c) else F.col(c)
                       for c in df.columns])


def _nested(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType))


# --- S2 / S5 ---------------------------------------------------------------------

# A record on a line of its own, with the framing an array file puts around it.
_LINE = r"^[\s\[,]*(\{.*\})[\s\],]*$"
_FRAME = r"^[\s\[\],\x{FEFF}]*$"
# What is left of a line's brackets when strings and other text are gone.
_BUT_BRACKETS = r'"(?:[^"\\]++|\\.)*+"|[^\[\]{}"]++'


def _literal(uri: str) -> str:
    """A file's URI as a read path: percent signs decoded, glob characters taken literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def one_record(line: Column, nested: int = 6) -> Column:
    """Whether a line is exactly one JSON object: its outermost pair of braces holds brackets that cancel out. Deeper
    nesting than ``nested`` says no, which only sends the file to the structural scan."""
    inner = F.regexp_replace(line, _BUT_BRACKETS, "")
    inner = F.substring(inner, F.lit(2), F.greatest(F.length(inner) - 2, F.lit(0)))
    for _ in range(nested):
        inner = F.regexp_replace(inner, r"\{\}|\[\]", "")
    return line.rlike(r"^\s*\{.*\}\s*$") & (inner == "")


# Files above LARGE bytes are not read by lines unless their lines are MEAN_LINE bytes long at most on average.
LARGE, MEAN_LINE = 16 << 20, 1 << 20


def _files(spark: SparkSession, path) -> dict[str, int]:
    """Names and sizes of the files; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("_metadata.file_path").alias("file"), "length")
    return {r["file"]: r["length"] for r in found.collect()}


def _long_lines(spark: SparkSession, sizes: dict[str, int]) -> set[str]:
    """Large files whose lines are long, an array in one line for instance, which no task should hold: found by
    fragments that end at ``}``."""
    large = [_literal(f) for f, n in sizes.items() if n > LARGE]
    if not large:
        return set()
    rows = json_scan.fragments(spark, large).groupBy("file").agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.count_if(F.contains("value", F.lit("\n"))).alias("n")).collect()
    return {r["file"] for r in rows if r["bytes"] > MEAN_LINE * (r["n"] + 1)}


def json_forms(spark: SparkSession, path) -> tuple[list[str], list[str]]:
    """(files in which every line is one record, all others), by the brackets of each line: a file with one line of
    another shape is none of the first, nor is a large one with long lines. Only file names reach the driver."""
    sizes = _files(spark, path)
    long = _long_lines(spark, sizes)
    rest = [_literal(f) for f, n in sizes.items() if n and f not in long]
    others = [_literal(f) for f in sorted(long)]
    if not rest:
        return [], others
    lines = spark.read.text(rest).select("value", F.col("_metadata.file_path").alias("file"))
    rows = lines.groupBy("file").agg(F.count_if(~F.col("value").rlike(r"^\s*$") & ~one_record(F.col("value")))
                                     .alias("n")).collect()
    return [_literal(r["file"]) for r in rows if not r["n"]], others + [_literal(r["file"]) for r in rows if r["n"]]


def _json_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line, file): the records of one-record-per-line files, framing removed; splits like any text."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.where(~F.col("value").rlike(_FRAME))
    record = F.regexp_extract("value", _LINE, 1)
    return lines.select(F.when(record != "", record).otherwise(F.col("value")).alias("line"), "file")


def json_records(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """((line, file, stray) of the files' records by structure, files whose brackets do not close). The records are
    written to the shared folder once: they are read more than once."""
    states = json_scan.entries(spark, paths).collect()
    broken = {r["file"] for r in states if not r["clean"]}
    whole = sorted({r["file"] for r in states} - broken)
    if not whole:
        return None, [_literal(f) for f in sorted(broken)]
    found = json_scan.records(spark, [_literal(f) for f in whole], [r for r in states if r["file"] not in broken])
    path = shared_path(spark, "json", "records")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path), [_literal(f) for f in sorted(broken)]


def _inferred(records: DataFrame) -> T.StructType:
    """Schema of JSON texts, found on the JVM."""
    spark = records.sparkSession
    texts = getattr(records.select("line")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return T._parse_datatype_json_string(spark._jsparkSession.read().json(texts).schema().json())


def load_json(spark: SparkSession, path: str, array_form: bool | None = None,
              schema: T.StructType | str | None = None) -> DataFrame:
    """JSON Lines, arrays and sequences of records in any layout, told apart by structure; files may be mixed, and
    all of them split across tasks. ``array_form`` forces one reading by Spark's own reader: True whole documents,
    False JSON Lines.

    Text that is no record gives a row of NULLs, as Spark's own reader does. A file whose brackets do not close is
    read by its lines if one of them at least is a record, else it raises: no record is lost without a word."""
    if array_form is not None:
        r = spark.read.option("multiLine", str(array_form).lower()).option("recursiveFileLookup", "true")
        return (r.schema(schema) if schema is not None else r).json(path)
    lines, others = json_forms(spark, path)
    parts = []
    if lines:
        r = spark.read.option("recursiveFileLookup", "true")
        parts.append((r.schema(schema) if schema is not None else r).json(lines))
    if others:
        found, broken = json_records(spark, others)
        texts = [found] if found is not None else []
        if broken:
            long = {_literal(f) for f in _long_lines(spark, _files(spark, broken))}
            if long:
                raise ValueError(f"brackets do not close in {', '.join(sorted(long)[:5])}")
            by_line = _json_lines(spark, broken)
            good = {_literal(r["file"]) for r in by_line.where(one_record(F.col("line"))).select("file").distinct().collect()}
            if set(broken) - good:
                raise ValueError(f"no JSON records in {', '.join(sorted(set(broken) - good)[:5])}: brackets do not close")
            texts.append(by_line.withColumn("stray", ~one_record(F.col("line"))))
        for t in texts:
            declared = schema if schema is not None else _inferred(t.where(~F.col("stray")))
            if declared == T.StructType([]):
                continue
            parts.append(t.select(F.from_json("line", declared).alias("r")).select("r.*"))
    if not parts:                                # no file has a record
        return spark.createDataFrame([], schema if schema is not None else T.StructType([]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def save_json(df: DataFrame, path: str) -> None:
    """JSON Lines (the pandas branch of the reference), overwrite; NULL fields are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _array_frame(batches):
    """``[``, comma-led records, ``]``, batch by batch; nothing for a partition without records."""
    import pandas as pd
    opened = False
    for pdf in batches:
        if pdf.empty:
            continue
        lead = pd.Series(",", index=pdf.index)
        if not opened:
            yield pd.DataFrame({"value": ["["]})
            lead.iloc[0] = ""
            opened = True
        yield pd.DataFrame({"value": lead + pdf["value"]})
    if opened:
        yield pd.DataFrame({"value": ["]"]})


def save_json_array(df: DataFrame, path: str) -> None:
    """S5 (store variant): every output file is one JSON array of records.

    Records are encoded by ``to_json`` on the JVM; a per-partition pass only
    frames them (``[``, comma-led records, ``]``) batch by batch, so memory
    stays at one Arrow batch whatever the partition size."""
    rec = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    rec.mapInPandas(_array_frame, "value string").write.mode("overwrite").text(path)


def save_json_layout(df: DataFrame, path: str, layout: str) -> None:
    """Records as other tools write them: ``compact`` (an array without line ends), ``joined`` (several records on a
    line, nothing around them) or ``indented`` (each record over several lines); every output file by itself."""
    options = {"ignoreNullFields": "false"} | ({"pretty": "true"} if layout == "indented" else {})
    rec = df.select(F.to_json(F.struct(*df.columns), options).alias("value"))
    if layout == "compact":
        framed = rec.mapInPandas(_array_frame, "value string")
    elif layout in ("joined", "indented"):
        framed = rec
    else:
        raise ValueError(f"no layout {layout!r}")
    sep = {"compact": " ", "joined": ", ", "indented": "\n"}[layout]
    framed.write.mode("overwrite").option("lineSep", sep).text(path)


# --- S3 / S6 ---------------------------------------------------------------------

def load_conll(spark: SparkSession, path: str, columns: tuple[str, str] = ("tokens", "labels")
               ) -> DataFrame:
    """S3: ``token<TAB>label`` lines; a blank line (after strip) ends a
    sentence; the last one is kept without a trailing blank line.

    The text source reads records separated by an empty line
    (``lineSep="\\n\\n"``), so files split across tasks like any text
    file (the line reader finishes a record that crosses a split). A record
    is then cut at lines holding only whitespace, and every line is stripped
    and split at the tab, all in native expressions. Files with CRLF line ends split at
    their own empty lines. A line without exactly one tab fails the read."""
    tok, lab = columns
    crlf = not spark.read.text(path, lineSep="\n").where(F.col("value").endswith("\r")).limit(1).isEmpty()
    raw = spark.read.text(path, lineSep="\r\n\r\n" if crlf else "\n\n")
    blocks = raw.select(F.explode(F.split("value", f"\n{WS_CLASS}*\n")).alias("block"))
    lines = blocks.select(F.filter(F.transform(F.split("block", "\n"), lambda x: strip_ws(x)),
                                   lambda x: x != F.lit("")).alias("lines"))
    pairs = lines.select(F.transform("lines", lambda x: F.split(x, "\t")).alias("p"))
    bad = F.exists("p", lambda a: F.size(a) != 2)
    pairs = pairs.where(F.size("p") > 0).select(F.when(bad, F.raise_error(F.concat(
        F.lit("not a token and a label: "), F.array_join(F.flatten("p"), " ")))).otherwise(F.col("p")).alias("p"))
    return pairs.select(
        F.transform("p", lambda a: a[0]).alias(tok),
        F.transform("p", lambda a: a[1]).alias(lab))


def save_conll(df: DataFrame, path: str, columns: tuple[str, str] = ("tokens", "labels")) -> None:
    """One ``token<TAB>label`` line per pair, a blank line after every
    sentence. Pairs are cut to the shorter array (Python ``zip``)."""
    tok, lab = columns
    n = F.least(F.size(tok), F.size(lab))
    lines = F.zip_with(F.slice(tok, 1, n), F.slice(lab, 1, n),
                       lambda t, l: F.concat(t, F.lit("\t"), l))
    df.select(F.concat(F.array_join(lines, "\n"), F.when(n > 0, F.lit("\n")).otherwise(F.lit("")))
              .alias("value")).write.mode("overwrite").text(path)


# --- S7 ------------------------------------------------------------------------

def _load_parquet(spark: SparkSession, path: str, **kw) -> DataFrame:
    return spark.read.parquet(path, **kw)


def _save_parquet(df: DataFrame, path: str, **kw) -> None:
    df.write.mode("overwrite").parquet(path, **kw)


# extension -> (reader, writer)
FORMATS = {".json": (load_json, save_json), ".csv": (load_csv, save_csv), ".conll": (load_conll, save_conll),
           ".parquet": (_load_parquet, _save_parquet)}


def _format_of(path: str):
    try:
        return FORMATS[_ext(path)]
    except KeyError:
        raise ValueError(f"no reader or writer for {_ext(path) or 'a path without extension'!r}; "
                         f"known: {', '.join(FORMATS)}") from None


def load(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Read by extension: ValueError for an unknown one, FileNotFoundError for a path without files."""
    reader, _ = _format_of(path)
    if not _exists(spark, path):
        raise FileNotFoundError(f"nothing to read at {path}")
    return reader(spark, path, **kw)


def save(df: DataFrame, path: str, **kw) -> None:
    """Write by extension, in the form that ``load`` reads back."""
    _, writer = _format_of(path)
    writer(df, path, **kw)


def _ext(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath))


# --- S12 / S8 / U2 -------------------------------------------------------------

def save_by_channel(df: DataFrame, path: str, fmt: str = "json", channel: str = "channel",
                    rows_per_file: int = 1_000_000) -> None:
    """One folder per channel; a rerun replaces only the channels it
    carries (dynamic partition overwrite). Empty input writes nothing.

    Rows are clustered by channel first, so a channel has few files; ``REBALANCE`` lets AQE split a large
    channel over several tasks, and a file holds at most ``rows_per_file`` rows."""
    out = (_flat_columns(df) if fmt == "csv" else df).hint("rebalance", channel)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(channel)
    w = w.option("maxRecordsPerFile", str(rows_per_file))
    w = w.options(**CSV_WRITE) if fmt == "csv" else w.option("ignoreNullFields", "false")
    w.format(fmt).save(path)


def channel_of_file(file: str = "_metadata.file_path") -> Column:
    """Channel named by a file: its ``channel=<name>`` folder when written by ``save_by_channel``, else the
    file name without extension. Paths are URIs (one percent level); folder values carry one more level,
    and the default partition stands for NULL."""
    def decoded(c):                               # percent only: a plus sign is a plus sign
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    path = decoded(F.col(file))
    folder = F.regexp_extract(path, r"/channel=([^/]+)/[^/]*$", 1)
    base = F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
    value = F.when(folder != "__HIVE_DEFAULT_PARTITION__", decoded(folder))
    return F.when(folder != F.lit(""), value).otherwise(base)


# Strings in either kind of quotes, and what lies between them.
_TOKEN = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|[^'"]++"""


def python_literals(c: Column) -> Column:
    """A list or dict written by Python's ``repr`` as JSON text: strings in single or double quotes with what they
    hold, None, True and False outside strings."""
    def token(x):
        inner = F.substring(x, F.lit(2), F.length(x) - 2)
        inner = F.replace(F.replace(inner, F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit('\\"'))
        plain = x
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            plain = F.regexp_replace(plain, rf"\b{word}\b", json_word)
        hexed = r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})"          # JSON knows four digits only
        return F.when(x.startswith("'"), F.concat(F.lit('"'), F.regexp_replace(inner, hexed, r"$1\\u00$2"), F.lit('"'))
                      ).when(x.startswith('"'), F.regexp_replace(x, hexed, r"$1\\u00$2")).otherwise(plain)
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), token), "")


def _csv_by_header(spark: SparkSession, glob: str, schema: T.StructType, tolerant: bool) -> list[DataFrame]:
    """CSV channel files read by their own headers: files are grouped by header line, columns taken by name,
    columns a file lacks become NULL."""
    lines = spark.read.text(glob).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"))
    heads = lines.groupBy("file").agg(F.min_by("value", F.struct("at", "n")).alias("head")).collect()
    by_head: dict[str, list[str]] = {}
    for r in heads:                               # names and header lines only
        by_head.setdefault(r["head"].rstrip("\r"), []).append(_literal(r["file"]))
    lenient = {"mode": "DROPMALFORMED", "ignoreCorruptFiles": "true"} if tolerant else {}
    parts = []
    options = _csv_options(True, ",")
    for files_ in by_head.values():
        found = csv_records(spark, files_)
        if found is None:
            c = spark.read.options(**options, **lenient).option("inferSchema", "false").csv(files_)
            c = c.select("*", F.col("_metadata.file_path").alias("_file"))
        else:
            texts = T.StructType([T.StructField(n, T.StringType()) for n in _header_of(found, options)])
            c = _parse_csv(found, texts, options, "file").withColumnRenamed("file", "_file")
        cols = []
        for f in schema:
            if f.name not in c.columns:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
                value = F.coalesce(F.from_json(f.name, f.dataType),
                                   F.from_json(python_literals(F.col(f.name)), f.dataType))
                if not tolerant:                  # text that is neither is not lost without a word
                    lost = value.isNull() & ~F.coalesce(F.trim(f.name), F.lit("")).isin("", "null", "None", "NaN", "nan")
                    value = F.when(lost, F.raise_error(F.concat(F.lit(f"{f.name} is no {f.dataType.typeName()}: "),
                                                                F.col(f.name)))).otherwise(value)
                cols.append(value.alias(f.name))
            else:
                value = F.col(f.name)
                cols.append((value.try_cast(f.dataType) if tolerant else value.cast(f.dataType)).alias(f.name))
        parts.append(c.select(*cols, channel_of_file("_file").alias("_channel")))
    return parts


def merge_channels(spark: SparkSession, schema: T.StructType, json_glob: str | None = None,
                   csv_glob: str | None = None, channel: str = "channel",
                   tolerant: bool = False) -> DataFrame:
    """S8 + U2: every JSON and CSV channel file into one frame with a ``channel`` column from the file. JSON
    files may be JSON Lines or arrays; CSV columns are matched by header and decoded to ``schema``
    (nested columns from JSON or Python literals). ``tolerant``: records that cannot be read yield no
    rows (and bad numbers NULL) instead of failing the job."""
    parts = []
    if json_glob:
        lines, others = json_forms(spark, json_glob)
        texts = [_json_lines(spark, lines).withColumn("stray", F.lit(False))] if lines else []
        if others:
            found, broken = json_records(spark, others)
            texts += [found] if found is not None else []
            if broken and not tolerant:
                raise ValueError(f"brackets do not close in {', '.join(broken[:5])}")
            if broken:                            # the lines that are records; a large file with long lines has none
                long = {_literal(f) for f in _long_lines(spark, _files(spark, broken))}
                broken = [f for f in broken if f not in long]
            if broken:
                texts.append(_json_lines(spark, broken).withColumn("stray", ~one_record(F.col("line"))))
        mode = {} if tolerant else {"mode": "FAILFAST"}
        for t in texts:
            t = t.where(~F.col("stray")) if tolerant else t
            parts.append(t.select(F.from_json("line", schema, mode).alias("r"), "file").select(
                "r.*", channel_of_file("file").alias("_channel")))
    if csv_glob:
        parts += _csv_by_header(spark, csv_glob, schema, tolerant)
    if not parts:
        if not (json_glob or csv_glob):
            raise ValueError("nothing to merge")
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(channel, T.StringType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumnRenamed("_channel", channel)
