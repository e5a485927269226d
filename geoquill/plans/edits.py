"""Queries that edit, copy, restrict and summarise whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from geoquill.operators import spatial
from geoquill.plans.registry import query, work
from geoquill.sources import tables


@query("select id, x, y, code, objtype, balance from pts union all select id + 1000000, x, y, 970, null, null from hubs")
def insert_rows(t):
    """New rows with some of the columns; the others are null"""
    return tables.insert(t.pts, t.hubs.select((F.col("id") + 1000000).alias("id"), "x", "y", F.lit(970).alias("code")))


@query("select id, code, objtype from pts where code <> 970")
def copied_selection(t):
    """A selection written as a table of its own and read from there"""
    return work(t).put(t.pts.where("code <> 970").select("id", "code", "objtype"), "copy")


@query("select id, code, balance from pts where balance > 0 and code in (970, 719)")
def layered_view(t):
    """A view with a condition, one of it without geometry, and values bound by name, none written into the text"""
    layer = t.spark.sql("select * from {pts} where balance > :least", {"least": 0}, pts=t.pts)
    return t.spark.sql("select id, code, balance from {layer} where code in (:a, :b)", {"a": 970, "b": 719}, layer=layer)


@query("select id, x, y, cast(null as bigint) as code, cast(null as varchar) as objtype, cast(null as bigint) as balance from hubs")
def empty_template(t):
    """An empty table of pts' columns stands in for pts, then hubs are appended"""
    return tables.append(tables.empty_like(t.pts), t.hubs)


@query("select id, x, y, cast(null as bigint) as code, cast(null as varchar) as objtype, cast(null as bigint) as balance from pts")
def geometry_copy(t):
    """Keys and geometry alone, in the schema of a template"""
    return tables.geometry_only(t.pts, ["id", "x", "y"], t.pts.schema)


@query("""select 'pts' as name, count(*) > 0 as has_rows, count(*) as n_rows from pts union all select 'none', count(*) > 0, count(*) from pts where code < 0""")
def table_state(t):
    """Whether tables hold rows, and how many"""
    one = lambda name, df: tables.state(df).select(F.lit(name).alias("name"), "has_rows", "n_rows")
    return one("pts", t.pts).unionByName(one("none", t.pts.where("code < 0")))


@query("select id, cast(null as varchar) as owner, 7 as rank, code, code * 2 as code_1 from pts")
def added_columns(t):
    """Typed columns, null or constant, from a list of pairs; a name that is taken gets a number"""
    d = tables.add_columns(t.pts, [("owner", "string"), ("rank", "int"), ("code", "int")], {"rank": 7})
    name = tables.unique_name(d, "code")
    return d.withColumn(name, F.col("code") * 2).select("id", "owner", "rank", "code", name)


@query("select id, code, objtype from pts")
def kept_columns(t):
    """Some columns dropped, then only the listed ones kept"""
    return t.pts.drop("balance", "absent").select("id", "code", "objtype")


@query("select a.id, a.code, b.balance as amount, b.objtype as kind from hubs h join pts a on a.id = h.id left join (select * from pts where code <> 970) b on a.id = b.id")
def carried_fields(t):
    """Chosen columns of another table, renamed, by key"""
    base = t.pts.join(t.hubs.select("id"), "id", "left_semi").select("id", "code")
    return tables.carry(base, t.pts.where("code <> 970"), "id", {"balance": "amount", "objtype": "kind"})


@query("""select id, case when balance is null then null when id % 3 = 0 then concat(cast(balance as varchar), '-', cast(balance - code % 9 as varchar)) else cast(balance as varchar) end as label from pts""")
def regulated_labels(t):
    """Highest and lowest level of regulated lakes in one label"""
    low = F.when(F.col("id") % 3 == 0, F.col("balance") - F.col("code") % 9)
    return t.pts.select("id", F.when(F.col("balance").isNotNull(), F.concat_ws("-", F.col("balance").cast("string"), low.cast("string"))).alias("label"))


@query("select p.id from pts p where exists (select 1 from boxes b where b.class like 'PROMO%' and p.x between b.xmin and b.xmax and p.y between b.ymin and b.ymax)")
def study_area(t):
    """rows inside the areas studied"""
    area = t.boxes.where(F.col("class").startswith("PROMO"))
    return spatial.select_by_location(t.pts, spatial.points_in_boxes(t.pts, area), "point_id").select("id")


@query("select p.id from pts p where not exists (select 1 from boxes b where p.x between b.xmin + 8 and b.xmax - 8 and p.y between b.ymin + 8 and b.ymax - 8 and b.xmin + 8 < b.xmax - 8 and b.ymin + 8 < b.ymax - 8)")
def outside_areas(t):
    """F32: points outside all areas, which are shrunk by 8 first"""
    return spatial.select_by_location(t.pts, spatial.points_in_boxes(t.pts, spatial.grow(t.boxes, -8)), "point_id", inverted=True).select("id")


@query("select category, main, count(*) as n, grouping(category) + grouping(main) as folded from landuse group by cube (category, main)")
def cube_counts(t):
    """Counts of every combination of two columns, of each alone, and of all"""
    return t.landuse.cube("category", "main").agg(F.count(F.lit(1)).alias("n"), (F.grouping("category").cast("int") + F.grouping("main").cast("int")).alias("folded"))


@query("""select line_id, rank() over w as r, dense_rank() over w as d, lag(line_id) over w2 as earlier, lead(length_cm, 1, 0) over w2 as later, sum(length_cm) over (w2 rows between 1 preceding and 1 following) as around from lines
window w as (partition by src order by length_cm), w2 as (partition by src order by length_cm, line_id)""")
def window_frames(t):
    """Ranks, neighbours and a moving sum among the lines that leave a node"""
    w, w2 = Window.partitionBy("src").orderBy("length_cm"), Window.partitionBy("src").orderBy("length_cm", "line_id")
    return t.lines.select("line_id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.lag("line_id").over(w2).alias("earlier"), F.lead("length_cm", 1, 0).over(w2).alias("later"), F.sum("length_cm").over(w2.rowsBetween(-1, 1)).alias("around"))


@query("select id, (xmax - xmin) * (ymax - ymin) as area from boxes order by area desc, id limit 25")
def largest_boxes(t):
    """A report of the 25 largest"""
    return t.boxes.select("id", ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area")).orderBy(F.desc("area"), "id").limit(25)


@query("""select line_id, concat(lpad(cast(length_cm // 3600 as varchar), 2, '0'), ':', lpad(cast(length_cm % 3600 // 60 as varchar), 2, '0'), ':', lpad(cast(length_cm % 60 as varchar), 2, '0')) as duration from lines""")
def durations(t):
    """Seconds as hours, minutes and seconds"""
    s = F.col("length_cm")
    return t.lines.select("line_id", F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60).alias("duration"))


@query("select id, code, objtype from pts where code = 970")
def json_round_trip(t):
    """Rows written as JSON lines and read back in their types"""
    own, path = t.pts.where("code = 970").select("id", "code", "objtype"), work(t).path("json")
    own.write.json(path)
    return t.spark.read.schema(own.schema).json(path)


@query("select id, objtype, x from pts union all select id, null, x from hubs")
def combined_tables(t):
    """Tables whose path matches a pattern, read as one; columns that some lack are null"""
    ws = work(t)
    t.pts.select("id", "objtype", "x").write.parquet(f"{ws.root}/layer_a")
    t.hubs.select("id", "x").write.parquet(f"{ws.root}/layer_b")
    return tables.combine(t.spark, f"{ws.root}/layer_*").select("id", "objtype", "x")


@query("select col, count(*) as n, sum(case when category = 'Skog' then 1 else 0 end) as forest from landuse where col not in (select n_nationkey from nation) group by col")
def area_units(t):
    """Every unit of area that the skip list doesn't name, at once"""
    left = tables.remaining_units(t.landuse, t.nation.select(F.col("n_nationkey").cast("bigint").alias("col")), "col")
    return left.groupBy("col").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("category") == "Skog").cast("int")).alias("forest"))
