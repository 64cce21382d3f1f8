"""The two plain-file jobs (P7 people cleaning, P8 JSON split) as Spark jobs.

The people "files" are text lines rendered from the customer and supplier
tables; the same cleaning runs on lines read with
:func:`ledgerline.sources.files.read_people_text` from real files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as T
from ledgerline.functions.dialect import div_trunc
from ledgerline.operators.keys import with_row_index
from ledgerline.sources.tables import Tables

HEADER = "first last middle phone address_no address"
NUM_SPLITS = 8


def people_lines(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two whitespace-separated people files (header first) as ``value`` lines.

    File 1 holds every customer; file 2 every supplier plus the customers
    with a negative balance again, upper-cased (the same person in both
    files with different letter case).  Tokens are separated by runs of
    blanks and tabs.
    """
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))

    def render(first: Column, last: Column, phone: Column, addr_no: Column, street: Column,
               sep: str = " ") -> Column:
        return F.concat_ws(sep, first, last, F.lit("-"), phone, addr_no, street, F.lit("street"))

    first, last = F.lower("c_mktsegment"), F.concat(F.lit("o'"), F.lower("n_name"))
    phone = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    addr_no = (F.col("c_custkey") * 7919).cast("string")
    cust = c.select(render(first, last, phone, addr_no, F.lower("n_name")).alias("value"))
    again = c.where(F.col("c_acctbal") < 0).select(
        render(F.upper(first), F.upper(last), phone, addr_no, F.lower("n_name"), " \t ").alias("value"))
    supp = t.supplier.select(render(
        F.lit("supplier"), F.lower("s_name"), (F.col("s_suppkey") * 7).cast("string"),
        F.col("s_nationkey").cast("string"), F.lit("mc-donald")).alias("value"))
    header = t.spark.createDataFrame([(HEADER,)], "value string")
    return header.unionByName(cust), header.unionByName(supp).unionByName(again)


MIN_FIELDS = 5


def _fields(lines: DataFrame) -> DataFrame:
    return lines.where(F.length(F.trim("value")) > 0).select("value", T.split_blanks("value").alias("t"))


def short_lines(lines: DataFrame) -> DataFrame:
    """Lines with too few fields to clean (P7's rejects)."""
    return _fields(lines).where(F.size("t") < MIN_FIELDS).select("value")


def clean_people(lines: DataFrame, header: str | None = HEADER, join_rest: bool = False) -> DataFrame:
    """Title-case names, dash 10-digit phones, keep the last 4 address digits,
    join tokens with commas, and drop duplicate lines across all inputs (SET4).

    Faithful to the reference: trailing address words become extra CSV
    fields; ``join_rest=True`` keeps them as one blank-separated field (S30).
    ``header`` drops lines by their text, for lines that no file reader has
    skipped.  Lines of fewer than five fields are left to :func:`short_lines`.
    """
    body = lines if header is None else lines.where(F.trim("value") != header)
    tok = _fields(body).where(F.size("t") >= MIN_FIELDS).select("t")
    t = F.col("t")
    rest = F.slice(t, 6, 1 << 20)
    if join_rest:
        rest = F.when(F.size(rest) > 0, F.array(F.array_join(rest, " "))).otherwise(F.array().cast("array<string>"))
    cleaned = F.concat(
        F.array(*[f(F.get(t, F.lit(i))) for i, f in enumerate(
            (T.python_title, T.python_title, lambda x: x, T.dash_phone, lambda x: T.last_chars(x, 4)))]),
        rest)
    return tok.select(F.array_join(cleaned, ",").alias("line")).distinct()


def people_clean(t: Tables) -> DataFrame:
    a, b = people_lines(t)
    return clean_people(a.unionByName(b))


def assign_splits(items: DataFrame, order_cols, n_splits: int = NUM_SPLITS) -> DataFrame:
    """``split_id`` 1..n in item order; split size ``count // n``.

    The reference slices with floor division and drops up to ``n - 1``
    trailing items (S29); here the remainder goes to the last split.
    """
    idx = with_row_index(items, order_cols, "_idx", base=-1)
    size = items.select((F.count(F.lit(1)) / n_splits).cast("long")).scalar()
    split = F.when(size == 0, F.lit(n_splits - 1).cast("long")).otherwise(
        F.least(div_trunc(F.col("_idx"), size), F.lit(n_splits - 1).cast("long")))
    return idx.withColumn("split_id", (split + 1).cast("int")).drop("_idx")


def json_split(t: Tables) -> DataFrame:
    """P8 summary: items of each split and which they are (the files themselves via ``write_split_json``)."""
    s = assign_splits(t.part.select("p_partkey"), ["p_partkey"])
    key = F.col("p_partkey").cast("bigint")
    return s.groupBy("split_id").agg(F.count(F.lit(1)).alias("n_items"), F.min(key).alias("first_key"),
                                     F.max(key).alias("last_key"), F.sum(key).alias("key_sum"))
