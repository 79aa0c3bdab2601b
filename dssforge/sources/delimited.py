"""Delimited text tables: ``|``-separated, no header, no quoting, empty field = NULL.

A backslash escapes the character after it: a separator, a backslash, or a line
break (``\\n``, ``\\r``). Quotes and blanks are ordinary characters. The benchmark's table
files end every line with a separator, which makes one extra, empty field.
Money is written with two decimals (``d.cc``), dates as ``yyyy-MM-dd``.

Lines are read with ``spark.read.text`` (a folder or glob of many files is split
across tasks like any file source) and cut at unescaped separators with
built-in expressions. A line with another number of fields than the schema,
or a field that is no value of its type, fails the read. CHAR columns are padded
in some files and lose their trailing blanks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, TimestampNTZType, TimestampType

from dssforge.sources.tables import Catalog, union_all

# --- fixed values: table file schemas in file order ---
TBL_SCHEMAS = {
    "region": "r_regionkey int, r_name string, r_comment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
    "supplier": "s_suppkey bigint, s_name string, s_address string, s_nationkey int, s_phone string, "
                "s_acctbal decimal(12,2), s_comment string",
    "customer": "c_custkey bigint, c_name string, c_address string, c_nationkey int, c_phone string, "
                "c_acctbal decimal(12,2), c_mktsegment string, c_comment string",
    "part": "p_partkey bigint, p_name string, p_mfgr string, p_brand string, p_type string, p_size int, "
            "p_container string, p_retailprice decimal(12,2), p_comment string",
    "partsupp": "ps_partkey bigint, ps_suppkey bigint, ps_availqty int, ps_supplycost decimal(12,2), "
                "ps_comment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(12,2), "
              "o_orderdate date, o_orderpriority string, o_clerk string, o_shippriority int, o_comment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity decimal(15,2), l_extendedprice decimal(12,2), l_discount decimal(4,2), "
                "l_tax decimal(4,2), l_returnflag string, l_linestatus string, l_shipdate date, "
                "l_commitdate date, l_receiptdate date, l_shipinstruct string, l_shipmode string, "
                "l_comment string",
}

DELETE_SCHEMA = "o_orderkey bigint"


def to_file_shape(df: DataFrame, table: str) -> DataFrame:
    """Columns of the table file in file order; columns the frame lacks are NULL (empty fields)."""
    cols = []
    for name, typ in schema_fields(TBL_SCHEMAS[table]):
        cols.append(F.col(name).cast(typ) if name in df.columns else F.lit(None).cast(typ).alias(name))
    return df.select(*cols)


# --- fixed values: columns declared CHAR (blank-padded) ---
CHAR_COLUMNS = {
    "c_phone", "c_mktsegment", "l_returnflag", "l_linestatus", "l_shipinstruct", "l_shipmode", "n_name",
    "o_orderstatus", "o_orderpriority", "o_clerk", "p_mfgr", "p_brand", "p_container", "r_name", "s_name", "s_phone",
}

# One field and the separator that ends it: plain characters, or a backslash with the character after it.
_FIELD = r"([^|\\]*+(?:\\.[^|\\]*+)*+)\|"


def schema_fields(schema: str) -> list[tuple[str, str]]:
    """(name, type) of a schema string."""
    return [tuple(part.split(None, 1)) for part in re.split(r",\s*(?![^()]*\))", schema)]


def _unescaped(text: Column) -> Column:
    """A field's characters without their backslashes."""
    plain = text
    for code, break_ in (("n", "\n"), ("r", "\r")):  # after an even number of backslashes
        plain = F.regexp_replace(plain, rf"(?<!\\)((?:\\\\)*)\\{code}", f"$1{break_}")
    return F.regexp_replace(plain, r"\\([^\n\r])", "$1")


def _parse(text: Column, name: str, kind: str) -> Column:
    if kind == "string":
        return F.when(text != "", F.rtrim(text) if name in CHAR_COLUMNS else text).alias(name)
    plain = F.rtrim(text) if name in CHAR_COLUMNS else text
    wrong = F.raise_error(F.concat(F.lit(f"no {kind} in field {name}: "), plain)).cast(kind)
    return F.coalesce(plain.try_cast(kind), F.when(text != "", wrong)).alias(name)


def load_delimited(spark: SparkSession, path: str, table: str | None = None, schema: str | None = None,
                   dummy: bool = True) -> DataFrame:
    """Read table files (file, folder or glob) with the table's schema.

    ``dummy=True`` expects the trailing separator of the benchmark's files;
    ``dummy=False`` reads files without it.
    """
    return parse_lines(spark.read.text(path), schema or TBL_SCHEMAS[table], dummy)


def parse_lines(lines: DataFrame, schema: str, dummy: bool = True) -> DataFrame:
    """Typed columns of ``schema`` in place of the text column ``value``; other columns stay, before them.

    Works on a stream of lines as on a table of them.
    """
    fields = schema_fields(schema)
    others = [x for x in lines.columns if x != "value"]
    end = "" if dummy else "|"
    line = F.concat(F.col("value"), F.lit(end)) if end else F.col("value")
    # Few lines hold a backslash: the others are cut at every separator, the last of which ends the line.
    cut = F.split(line, r"\|", -1)
    found = F.regexp_extract_all(line, F.lit(_FIELD), 1)
    whole = F.regexp_like(line, F.lit(f"(?s)^(?:{_FIELD})*+$"))
    wrong = F.raise_error(F.concat(F.lit(f"not {len(fields)} fields: "), F.col("value"))).cast("array<string>")
    escaped = F.when(whole & (F.size(found) == len(fields)), F.transform(found, _unescaped)).otherwise(wrong)
    plain = ~F.contains(F.col("value"), F.lit("\\"))
    parts = lines.select(*others, "value", F.when(plain, cut).otherwise(escaped).alias("f"))
    fits = ~plain | ((F.size("f") == len(fields) + 1) & (F.get("f", F.lit(len(fields))) == ""))
    checked = parts.select(*others, F.when(fits, F.col("f")).otherwise(wrong).alias("f"))
    return checked.select(*others, *[_parse(F.get("f", F.lit(i)), name, kind) for i, (name, kind) in enumerate(fields)])


def load_delete_keys(spark: SparkSession, path: str, dummy: bool = True) -> DataFrame:
    """A delete key file: one order key per line."""
    return load_delimited(spark, path, schema=DELETE_SCHEMA, dummy=dummy)


#: Types whose text never holds a character to escape.
_PLAIN = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def _text(column: str, kind: DataType) -> Column:
    """A value as escaped text; NULL is empty."""
    text = F.col(column).cast("string")
    if not isinstance(kind, _PLAIN):
        for mark, code in (("\\", "\\\\"), ("|", "\\|"), ("\n", "\\n"), ("\r", "\\r")):  # backslashes first
            text = F.replace(text, F.lit(mark), F.lit(code))
    return F.coalesce(text, F.lit(""))


def write_delimited(df: DataFrame, path: str, trailing_separator: bool = True, mode: str = "errorifexists",
                    compression: str | None = None, folders: dict[str, Column] | None = None) -> None:
    """Write rows as ``|``-separated text in the table file format (NULL and the empty text are both empty).

    ``folders`` names values whose rows go to a folder of their own (``{path}/{name}={value}``), all in one pass.
    """
    line = F.concat_ws("|", *[_text(f.name, f.dataType) for f in df.schema])
    line = F.concat(line, F.lit("|")) if trailing_separator else line
    folders = folders or {}
    w = df.select(line.alias("value"), *[x.alias(name) for name, x in folders.items()]).write.mode(mode)
    if folders:
        w = w.partitionBy(*folders)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def load_counts(cat: Catalog, tables: list[str] | None = None) -> DataFrame:
    """Rows per table (the loader's inserted-row report)."""
    names = tables or ["region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem"]
    return union_all([cat.table(t).agg(F.count(F.lit(1)).alias("tuples"))
                      .select(F.lit(t).alias("table_name"), "tuples") for t in names])
