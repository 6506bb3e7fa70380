"""Pages of a query: by key set (rows after a cursor) or by offset, and the predicates of incremental reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name of the paging column beside the user's own ones.
CURSOR = "_pgcursor"


def keyset_page(df: DataFrame, cursor: str, after, size: int) -> DataFrame:
    """The next `size` rows by cursor after a value (None: from the start), with the cursor repeated as CURSOR. Null cursors are never read."""
    if cursor not in df.columns:
        raise ValueError(f"Cursor column '{cursor}' must be in the query's select list")
    page = df.withColumn(CURSOR, F.col(f"`{cursor}`"))
    page = page.where(F.col(CURSOR).isNotNull() if after is None else F.col(CURSOR) > F.lit(after))
    return page.orderBy(CURSOR).limit(size)


def offset_page(df: DataFrame, order_by: list[str], size: int, offset: int) -> DataFrame:
    """Rows offset to offset + size in an explicit order."""
    if not order_by:
        raise ValueError("Offset pages need an explicit order")
    return df.orderBy(*order_by).offset(offset).limit(size)


def strip(df: DataFrame, *names: str) -> DataFrame:
    """df without the named columns, those that are there."""
    return df.drop(*names)


def page_sql(sql: str, cursor: str | None, size: int, offset: int = 0, dialect: str = "limit") -> str:
    """A page of an SQL query as SQL: after :_cursor by key set, or by offset. dialect: `limit` or `fetch`."""
    rows = {"limit": lambda a, b: f"LIMIT {a}" + (f" OFFSET {b}" if b is not None else ""), "fetch": lambda a, b: (f"OFFSET {b} ROWS " if b is not None else "") + f"FETCH NEXT {a} ROWS ONLY"}[dialect]
    if cursor:
        name = f'"{CURSOR}"' if dialect == "fetch" else CURSOR
        return f"SELECT * FROM (SELECT i.*, i.{cursor} AS {name} FROM ({sql}) i) p WHERE {name} > :_cursor ORDER BY {name} {rows(size, None)}"
    return f"SELECT * FROM ({sql}) p {rows(size, offset)}"


def page_count(rows: int, size: int) -> int:
    """Pages that a loop reads which ends with the first page that is not full."""
    return rows // size + 1


def any_of(column: str, values: list) -> Column:
    """column equal to one of values; a null among them matches null."""
    plain = [v for v in values if v is not None]
    found = F.col(f"`{column}`").isin(*plain) if plain else F.lit(False)
    return found | F.col(f"`{column}`").isNull() if len(plain) < len(values) else found


def after_watermark(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows above a high-water mark; all rows without one."""
    return df if watermark is None else df.where(F.col(f"`{column}`") > F.lit(watermark))
