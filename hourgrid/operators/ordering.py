"""Total orders over tables of any size: ranks, positions, running sums, exact quantiles.

A window without partition keys pulls the whole table into one task. Here a row's bucket is a
function of its sort key: the number of bounds below it, the bounds being every n-th key of a
sorted random sample of fixed size. Windows run inside buckets, and the totals of the buckets
before, one row a bucket, are added. Keys end in tie columns, so equal ranks spread over
several buckets.

All of it is one statement over common table expressions: the rows feed the sample and the
buckets, the buckets feed the windows and the totals. Each carries a random column, because
Spark computes an expression that is not deterministic once, behind one exchange that all its
readers share with the columns they need, and would copy a deterministic one into every
reader. Nothing runs before the result is asked for, and nothing is left behind (for one
exception see ``_over``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.session import settle

SAMPLE_PER_BUCKET = 100


def desc(*columns: str) -> list[Column]:
    """Descending sort keys, nulls last (Spark's default for descending)."""
    return [F.desc(c) for c in columns]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ascending(df: DataFrame, order: list[str]) -> str:
    """SQL of one value that sorts as ``order`` does; ``-name`` is descending, nulls last."""
    parts = []
    for name in order:
        column = _quoted(name.removeprefix("-"))
        if not name.startswith("-"):
            parts.append(column)
            continue
        kind = df.schema[name[1:]].dataType
        if not isinstance(kind, T.NumericType):
            raise TypeError(f"{name[1:]} is not a number and cannot be descending")
        floating = f"NOT isnan({column}), " if isinstance(kind, (T.FloatType, T.DoubleType)) else ""
        parts.append(f"struct({column} IS NULL, {floating}-{column})")
    return f"struct({', '.join(parts)})"


def bucketed(buckets: int, source: str, key: str, rank_key: str = "NULL") -> str:
    """The expressions ``rows`` and ``placed``: the rows of ``source`` with key, rank key and bucket."""
    return f"""
    rows AS (SELECT *, {key} AS __key, {rank_key} AS __rank_key, uuid() AS __draw FROM {source}),
    sample AS (SELECT __key FROM rows ORDER BY __draw LIMIT {SAMPLE_PER_BUCKET * buckets}),
    bounds AS (
      SELECT filter(keys, (k, i) -> i % greatest(size(keys) DIV {buckets}, 1) = 0 AND i > 0) AS bounds
      FROM (SELECT array_sort(collect_list(__key)) AS keys FROM sample)
    ),
    bounded AS (SELECT *, (SELECT bounds FROM bounds) AS __bounds FROM rows),
    placed AS (
      SELECT /*+ REPARTITION({buckets}, __bucket) */ * EXCEPT (__bounds), uuid() AS __once
      FROM (SELECT * EXCEPT (__draw), size(filter(__bounds, b -> b < __key)) AS __bucket FROM bounded)
    )"""


def _over(df: DataFrame, statement: str) -> DataFrame:
    """The statement over ``df``, planned at once; nothing runs.

    Spark 4.1 cannot plan dynamic partition pruning inside a shared expression. Where ``df``
    has such a join, its rows are checkpointed first and the statement reads the checkpoint.
    """
    out = df.sparkSession.sql(statement, df=df)
    try:
        out._jdf.queryExecution().optimizedPlan()
    except Exception:  # whatever cannot be planned over the checkpoint either is raised below
        out = df.sparkSession.sql(statement, df=settle(df))
    return out


def _buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_rank_all(
    df: DataFrame,
    by: list[str],
    name: str,
    within: tuple[str, ...] = (),
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """dense_rank by ``by`` descending, over everything or inside each ``within`` value.

    ``tie`` columns only spread equal ranks over several buckets; they never change a rank.
    """
    falling = [f"-{c}" for c in by]
    groups = [_quoted(c) for c in within]
    listed = "".join(f"{g}, " for g in groups)
    inside = f"PARTITION BY {', '.join(groups)} " if groups else ""
    same = " AND ".join(f"ranked.{g} <=> starts.{g}" for g in [*groups, "__bucket"])
    # a rank that goes on in the next bucket must not be counted twice
    statement = f"""WITH {bucketed(_buckets(df), '{df}', _ascending(df, [*within, *falling, *tie]), _ascending(df, falling))},
    ranked AS (
      SELECT *, dense_rank() OVER (PARTITION BY {listed}__bucket ORDER BY __rank_key) AS __local FROM placed
    ),
    totals AS (
      SELECT {listed}__bucket, max(__local) AS n, min(__rank_key) AS first, max(__rank_key) AS last
      FROM ranked GROUP BY {listed}__bucket
    ),
    carried AS (
      SELECT *, CASE WHEN first <=> lag(last) OVER ({inside}ORDER BY __bucket) THEN 1 ELSE 0 END AS again FROM totals
    ),
    starts AS (
      SELECT {listed}__bucket, coalesce(sum(n) OVER ({inside}ORDER BY __bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        - sum(again) OVER ({inside}ORDER BY __bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before
      FROM carried
    )
    SELECT {', '.join(f'ranked.{_quoted(c)}' for c in df.columns)}, __local + before AS {_quoted(name)}
    FROM ranked JOIN starts ON {same}"""
    return _over(df, statement)


def numbered(columns: list[str], name: str, out: str, summed: str, grand: str) -> str:
    """Over ``placed``: position, running sum and grand total, as the expression ``numbered``."""
    value = _quoted(summed)
    return f"""
    totals AS (SELECT __bucket, count(*) AS n, sum({value}) AS t FROM placed GROUP BY __bucket),
    starts AS (
      SELECT __bucket, coalesce(sum(n) OVER earlier, 0) AS n_before, coalesce(sum(t) OVER earlier, 0) AS t_before, sum(t) OVER () AS t_all
      FROM totals WINDOW earlier AS (ORDER BY __bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    numbered AS (
      SELECT {', '.join(columns)}, n_before + row_number() OVER inside AS {_quoted(name)},
        t_before + sum({value}) OVER inside AS {_quoted(out)}, t_all AS {_quoted(grand)}
      FROM (SELECT placed.*, n_before, t_before, t_all FROM placed JOIN starts ON placed.__bucket = starts.__bucket)
      WINDOW inside AS (PARTITION BY __bucket ORDER BY __key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    )"""


def number_all(
    df: DataFrame,
    order: list[str],
    name: str,
    running: tuple[str, str],
    grand: str,
) -> DataFrame:
    """1-based position in the total order, running sum and grand total of one column.

    ``order`` names columns, ``-name`` for descending; it should end in a unique key, so that
    positions are repeatable. ``running`` is (output name, summed column).
    """
    out, summed = running
    columns = [_quoted(c) for c in df.columns]
    statement = f"""WITH {bucketed(_buckets(df), '{df}', _ascending(df, order))},
    {numbered(columns, name, out, summed, grand)}
    SELECT * FROM numbered"""
    return _over(df, statement)


def _quantiles(buckets: int, points: dict[str, float]) -> str:
    """Over ``folded (v, c)``, distinct values and their counts: the expression ``quantiles``, one row."""
    picks = ", ".join(f"""{_at('floor', p)} AS {_quoted('lo_' + n)}, {_at('ceil', p)} AS {_quoted('hi_' + n)},
        max((whole - 1) * {p}D - floor((whole - 1) * {p}D)) AS {_quoted('w_' + n)}""" for n, p in points.items())
    mixed = ", ".join(f"{_quoted('lo_' + n)} + ({_quoted('hi_' + n)} - {_quoted('lo_' + n)}) * {_quoted('w_' + n)} AS {_quoted(n)}" for n in points)
    return f"""{bucketed(buckets, 'folded', 'struct(v)')},
    {numbered(['v', 'c'], 'place', 'upto', 'c', 'whole')},
    quantiles AS (SELECT {mixed} FROM (SELECT {picks} FROM numbered))"""


def _at(side: str, p: float) -> str:
    """The value at the 0-based place that is ``side`` of the quantile's."""
    place = f"{side}((whole - 1) * {p}D)"
    return f"max(CASE WHEN {place} >= upto - c AND {place} < upto THEN v END)"


def exact_quantiles(df: DataFrame, value: str, points: dict[str, float]) -> DataFrame:
    """One row with linearly interpolated quantiles of the non-null values.

    The values are first folded to distinct value and count, so a hot value is one row.
    """
    x = _quoted(value)
    statement = f"""WITH folded AS (SELECT {x} AS v, count(*) AS c FROM {{df}} WHERE {x} IS NOT NULL GROUP BY {x}),
    {_quantiles(_buckets(df), points)}
    SELECT * FROM quantiles"""
    return _over(df, statement)


def between_quantiles(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """The rows whose ``value`` lies between two exact quantiles, ends included; ``df`` is computed once."""
    x = _quoted(value)
    statement = f"""WITH given AS (SELECT *, uuid() AS __given FROM {{df}}),
    folded AS (SELECT {x} AS v, count(*) AS c FROM given WHERE {x} IS NOT NULL GROUP BY {x}),
    {_quantiles(_buckets(df), {'low': low, 'high': high})}
    SELECT {', '.join(f'given.{_quoted(c)}' for c in df.columns)} FROM given JOIN quantiles ON {x} >= low AND {x} <= high"""  # one row beside
    return _over(df, statement)
