"""CSV ingest with pandas-like type inference (A1, A2), report sinks (A5), preview (A4).

Spark's ``inferSchema`` is not used: one ``NA`` cell makes it type a numeric
column as STRING, and it turns date text into DATE where a pandas reader keeps
text.  Instead every column is read as text, missing tokens become NULL, and
each cell then gives a bit mask of the types it fits, one ``bit_and`` a column meets
them, and a single ``select`` of ``try_cast`` applies the narrowest type left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — text read as missing (the default missing tokens of a pandas CSV reader).
# ---------------------------------------------------------------------------
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Text read as booleans.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, infer: bool = True, multi_line: bool = False) -> DataFrame:
    """A1: CSV with a header, quoted as pandas reads it (a doubled quote is a quote).

    ``path`` may be anything Spark reads (URIs, globs, several files); a missing one fails with Spark's
    PATH_NOT_FOUND.  ``multi_line=True`` lets quoted fields hold line feeds; such a file can't be split
    among tasks, so it is an option.
    """
    raw = (spark.read.option("header", True).option("inferSchema", False).option("quote", '"').option("escape", '"')
           .option("multiLine", multi_line).option("nullValue", None).option("emptyValue", "").csv(path))
    return infer_types(raw) if infer else raw


def _missing(c) -> F.Column:
    return F.when(~F.col(f"`{c}`").isin(NA_TOKENS) & F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`"))


# a number as text: no type suffix, so that a code such as 12D stays text
NUMBER = r"^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$|^[+-]?(inf|Inf|INF|infinity|Infinity)$"


def _double(c: str) -> str:
    return f"case when trim(`{c}`) rlike '{NUMBER}' then try_cast(trim(`{c}`) as double) end"


# bits of the types a cell fits, narrowest first; any cell is text
FITS_LONG, FITS_DOUBLE, FITS_BOOLEAN, FITS_TEXT = 1, 2, 4, 8


def _fits(c: str) -> F.Column:
    """Bit mask of the types that the text of a cell fits; NULL for a missing one, which fits all."""
    v = F.trim(F.col(c))
    return F.when(v.isNotNull(), F.lit(FITS_TEXT)
                  + F.when(F.expr(f"try_cast(trim(`{c}`) AS BIGINT)").isNotNull(), FITS_LONG).otherwise(0)
                  + F.when(F.expr(_double(c)).isNotNull(), FITS_DOUBLE).otherwise(0)
                  + F.when(v.isin(TRUE_TOKENS + FALSE_TOKENS), FITS_BOOLEAN).otherwise(0))


def infer_types(df: DataFrame) -> DataFrame:
    """A2: NA tokens → NULL, then BIGINT / DOUBLE / BOOLEAN / STRING per column: one aggregate a column, one pass.

    A column without a value becomes DOUBLE."""
    cols = df.columns
    clean = df.select(*[_missing(c).alias(c) for c in cols])
    row = clean.agg(*[F.bit_and(_fits(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()   # a number a column
    out = []
    for i, c in enumerate(cols):
        mask = row[f"m{i}"]
        v = F.trim(F.col(c))
        if mask is None:
            out.append(F.col(c).cast("double").alias(c))
        elif mask & FITS_LONG:
            out.append(F.expr(f"try_cast(trim(`{c}`) AS BIGINT)").alias(c))
        elif mask & FITS_DOUBLE:
            out.append(F.expr(_double(c)).alias(c))
        elif mask & FITS_BOOLEAN:
            out.append(F.when(v.isin(TRUE_TOKENS), True).when(v.isin(FALSE_TOKENS), False).alias(c))
        else:
            out.append(F.col(c))
    return clean.select(*out)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A5: write a result/report/chart table (reports are small; data-sized tables keep
    their partitioning)."""
    df.write.mode(mode).format(fmt).save(path)


def preview(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    """A4: first ``n`` rows in an explicit order (TakeOrdered, no global sort)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).limit(n)
