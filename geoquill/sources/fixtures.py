"""Feature tables derived from the base tables with integer arithmetic, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_HASH_XY = "(k * k * 31 + k * 7919) % 10007 as x, (k * k * k * 17 + k * 104729) % 10007 as y"

DERIVED = {
    "pts": f"""select k as id, {_HASH_XY},
  case n % 12 when 0 then 970 when 1 then 719 when 2 then 671 when 3 then 113 when 4 then 111 when 5 then 151
    when 6 then 531 when 7 then 721 when 8 then 172 when 9 then 956 when 10 then 729 else 777 end as code, objtype, balance
  from (select cast(c_custkey as bigint) as k, cast(c_nationkey as bigint) as n, c_mktsegment as objtype, cast(round(c_acctbal) as bigint) as balance from customer) c""",
    "hubs": f"select k as id, {_HASH_XY} from (select cast(s_suppkey as bigint) as k from supplier) s",
    "lines": """select o * 8 + n as line_id, o as src, dst, (o % 64) * 100 as x1, cast(floor(o / 64.0) as bigint) * 100 as y1,
  (dst % 64) * 100 as x2, cast(floor(dst / 64.0) as bigint) * 100 as y2, cast(case when n % 3 = 2 then 14142 else 10000 end as bigint) as length_cm,
  substr('ERFKPSBTDAUG', cast(o % 12 as int) + 1, 1) as category, cast((o + n) % 10 as int) as class, substr('TLUB', cast((o * 7 + n) % 4 as int) + 1, 1) as medium
  from (select o, n, o + case n % 3 when 0 then 1 when 1 then 64 else 65 end as dst from
    (select distinct cast(l_orderkey as bigint) as o, cast(l_linenumber as bigint) as n from lineitem) d
    where (o * o * 31 + o * 7919 + n * n * 1009 + n * 104729) % 101 < 24) e""",
    "boxes": """select k as id, (k * k * 37 + k * 7919) % 10007 as xmin, (k * k * k * 13 + k * 3571) % 10007 as ymin,
  (k * k * 37 + k * 7919) % 10007 + 10 + s * 4 as xmax, (k * k * k * 13 + k * 3571) % 10007 + 10 + (k % 37) * 5 as ymax, class
  from (select cast(p_partkey as bigint) as k, cast(p_size as bigint) as s, p_type as class from part) p""",
    "landuse": """select k as id, k % 64 as col, cast(floor(k / 64.0) as bigint) as row,
  case (k * k * 31 + k * 7) % 6 when 0 then 'Skog' when 1 then 'Myr' when 2 then 'Vann' when 3 then 'Bebyggelse' when 4 then 'Dyrket' else 'Aapent' end as category,
  main, sub, cast(k % 3 as varchar(9)) as ground from (select cast(o_orderkey as bigint) as k, o_orderstatus as main, o_orderpriority as sub from orders) o""",
    "tracks": """select k as id, case when own then 2 * k else 2 * k - 1 end as src, 2 * k + 1 as dst, sx as x1, sy as y1, sx + (k % 4) * 15 - 20 as xm, sy + (k % 3) * 15 - 10 as ym,
  case when own then ex else sx + (k % 6) * 40 - 90 end as x2, case when own then ey else sy + (k % 11) * 20 - 105 end as y2
  from (select k, own, case when own then ox else ox + (b % 7) * 40 - 120 end as sx, case when own then oy else oy + (b % 5) * 50 - 90 end as sy, ox + (b % 7) * 40 - 120 as ex, oy + (b % 5) * 50 - 90 as ey
    from (select k, b, b = k as own, (b * b * 31 + b * 7919) % 10007 as ox, (b * b * b * 17 + b * 104729) % 10007 as oy
      from (select k, case when k % 3 = 1 then k - 1 else k end as b from (select cast(c_custkey as bigint) as k from customer) c) d) e) f""",
    "circles": """select h * 32 + k as line_id, h * 8 + k as src, h * 8 + (k + 1) % 6 as dst, hx + ox as x1, hy + oy as y1, hx + px as x2, hy + py as y2, 'roundabout' as kind, h % 3 as number,
  case when h % 4 = 0 then 'U' when h % 4 = 1 and k = 2 then 'U' else 'T' end as medium
  from (select cast(s_suppkey as bigint) as h, cast(s_suppkey * 131 % 997 as bigint) * 50 as hx, cast(s_suppkey * 577 % 991 as bigint) * 50 as hy from supplier) s,
  (values (0, 20, 0, 10, 18), (1, 10, 18, -10, 18), (2, -10, 18, -20, 0), (3, -20, 0, -10, -18), (4, -10, -18, 10, -18), (5, 10, -18, 20, 0)) as c(k, ox, oy, px, py)
  union all select h * 32 + 8 + k, h * 8 + k, (h + k % 2) * 8 + (k + 3) % 6, 0, 0, 0, 0, 'road', h % 3, case when (h + k) % 3 = 0 then 'U' else 'T' end
  from (select cast(s_suppkey as bigint) as h from supplier) s, (values (0), (1), (2), (3), (4), (5)) as c(k)""",
    "diamonds": """select k as id, g, k % 2 as layer, (g * g * 37 + g * 7919) % 10007 + (k % 4) * 7 as cx, (g * g * g * 13 + g * 3571) % 10007 + (k % 3) * 5 as cy, 6 + s % 9 as r, case when k % 5 = 0 then 2 + s % 9 else 0 end as h
  from (select cast(p_partkey as bigint) as k, cast(floor(p_partkey / 4.0) as bigint) as g, cast(p_size as bigint) as s from part) p""",
    "rules": """select * from (values (1, 'Skog', '*', '1-URGENT', '*', 'Tett', 'N'), (2, 'Skog', 'O', '*', '*', 'Aapen', 'J'), (3, 'Skog', '*', '*', '2', 'Lav', 'J'),
  (4, 'Myr', 'F', '*', '0', 'Vaat', 'N'), (5, 'Myr', '*', '*', '*', 'Torr', 'J'), (6, 'Vann', '*', '2-HIGH', '1', 'Elv', 'N'), (7, 'Dyrket', 'P', '*', '*', 'Beite', 'J')) as r(rule_no, a, h, u, g, new_class, pass)""",
}


def without_overflow(sql: str) -> str:
    """The same remainders of cubes by way of the key's own remainder: cubes of keys beyond some 800,000 don't fit a bigint.

    Both terms of a cube have the key's sign, so the results are equal for negative keys too.
    """
    r = r"(\1 % \4)"
    return re.sub(r"\((\w) \* \1 \* \1 \* (\d+) \+ \1 \* (\d+)\) % (\d+)", rf"({r} * {r} * {r} * \2 + {r} * \3) % \4", sql)


class Tables:
    """Base tables of a folder by name, and the derived ones."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        if name in DERIVED:
            used = {b: getattr(self, b) for b in BASE if f"from {b})" in DERIVED[name]}
            sql = without_overflow(DERIVED[name])
            for b in used:
                sql = sql.replace(f"from {b})", f"from {{{b}}})")
            return self.spark.sql(sql, **used)
        raise AttributeError(name)


def with_derived(sql: str) -> str:
    """The query behind the derived tables that it names; a query that begins with WITH RECURSIVE goes on from them."""
    used = [f"{n} as ({q})" for n, q in DERIVED.items() if re.search(rf"\b{n}\b", sql)]
    recursive = sql.lstrip().lower().startswith("with recursive")
    rest = re.sub(r"^\s*with( recursive)?\s", "", sql, flags=re.I) if re.match(r"\s*with\b", sql, re.I) else None
    head = "with recursive " if recursive else "with "
    return (head + ",\n".join(used) + (",\n" + rest if rest is not None else "\n" + sql)) if used else sql
