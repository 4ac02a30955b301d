"""Synthetic stacked cube built from the TPC-H-style tables.

The cube has the shape of a published "stacked aggregate panel": three time
grains, totals beside their components (geography ``ALL``, sex ``All``, band
``All Bands``), an overlapping sub-geography and overlapping bands, small
cells suppressed with a footnote and the last month and year incomplete.

Scale design
------------
* Only the eight needed columns are read from the four tables (column pruning
  reaches the parquet scans).
* ``nation`` is broadcast only after a row-count check; the fact-to-fact
  joins (orders-customer, lineitem-orders) are sort-merge joins on their keys
  (AQE splits skewed partitions).
* The joined rows are aggregated to a *fine* table whose key domain is fixed
  (nation x nested flag x line status x band pair x month), with map-side
  partial aggregation, before anything is expanded. Every later step works on
  that bounded table, so the cost of the cube beyond the one big scan+join is
  independent of the input size. The fine table is written once to shared
  storage (``spark.checkpoint.dir``) so a lost executor never forces a rescan
  of the fact tables.
* Cells are produced by exploding the overlapping memberships (geo, sex,
  band) of the fine rows, summing to month cells and rolling months up to
  years and the total with one grouping-sets aggregate; the dense grid comes from one aggregated bounds row
  exploded over the domains, with no cartesian join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import contract as K
from tessera.session import bounded_broadcast

COUNT_COLS = ["total", "a", "b", "overlap", "c", "union_cnt"]


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def _band_case(q: Column, bands) -> Column:
    expr = None
    for label, lo, hi in bands:
        cond = (q >= lo) & (q <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


FLAG_A, FLAG_B, FLAG_C = 1, 2, 4  # bit mask of the three base predicates


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One compact row per lineitem: nation key, nested flag, status, quantity,
    ship date and a 3-bit predicate mask.

    Everything derivable from lineitem alone is computed *before* the joins,
    so the two fact-table shuffles carry ints and a date instead of three
    doubles, two strings and a timestamp; the nation name (a string) joins
    only after aggregation, on the bounded fine table.
    """
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    lineitem = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_shipdate", "l_linestatus", "l_quantity", "l_returnflag", "l_discount", "l_tax",
    )
    nested_keys = bounded_broadcast(
        nation.filter(F.col("n_name") == K.NESTED_PARENT).select(F.col("n_nationkey").alias("__nk")), 10_000)
    cust = customer.join(nested_keys, customer.c_nationkey == nested_keys["__nk"], "left").select(
        "c_custkey",
        F.col("c_nationkey").alias("nk"),
        (F.col("__nk").isNotNull() & (F.col("c_mktsegment") == K.NESTED_SEGMENT)).alias("nested"),
    )
    li = lineitem.select(
        "l_orderkey",
        F.to_date("l_shipdate").alias("d"),
        F.col("l_linestatus").alias("ls"),
        F.col("l_quantity").cast("int").alias("q"),
        (F.when(F.col("l_returnflag") == K.RETURNFLAG_A, FLAG_A).otherwise(0)
         + F.when(F.col("l_discount") >= K.DISCOUNT_B_MIN, FLAG_B).otherwise(0)
         + F.when(F.col("l_tax") >= K.TAX_C_MIN, FLAG_C).otherwise(0)).cast("tinyint").alias("flags"),
    )
    # fact-to-fact joins grow with the data: pin them to sort-merge (spills,
    # AQE splits skewed partitions) instead of trusting a compressed-file-size
    # estimate that can make the planner broadcast a fact table
    ords = orders.join(cust.hint("merge"), orders.o_custkey == cust.c_custkey).select("o_orderkey", "nk", "nested")
    return li.join(ords.hint("merge"), li.l_orderkey == ords.o_orderkey).select(
        "nk", "nested", "ls", "q", "d", "flags")


def fine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate the fact rows to the bounded fine key (partial agg before
    shuffle), then attach nation names and band labels to that small table."""
    rows = base_rows(spark, sf_dir)
    fl = F.col("flags")
    fa, fb, fc = ((fl.bitwiseAND(bit) != 0) for bit in (FLAG_A, FLAG_B, FLAG_C))
    q = F.col("q")
    agg = rows.groupBy("nk", "nested", "ls", _band_case(q, K.EXCLUSIVE_BANDS).alias("xband"),
                       _band_case(q, K.OVERLAP_BANDS).alias("aband"), F.trunc("d", "month").alias("m")).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(fa.cast("int")).cast("bigint").alias("a"),
        F.sum(fb.cast("int")).cast("bigint").alias("b"),
        F.sum((fa & fb).cast("int")).cast("bigint").alias("overlap"),
        F.sum(fc.cast("int")).cast("bigint").alias("c"),
        F.sum((fa | fb | fc).cast("int")).cast("bigint").alias("union_cnt"),
        F.max("d").alias("max_d"),
    )
    names = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return agg.join(names, agg.nk == names.n_nationkey).select(
        F.col("n_name").alias("geo_name"), "nested", "ls", "xband", "aband", "m",
        *COUNT_COLS, "max_d")


def _non_null(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.isNotNull())


def cube_cells(fine: DataFrame) -> DataFrame:
    """Sum fine rows into every cube cell they belong to (present cells only).

    Geography, sex and band memberships overlap, so they are exploded (at most
    3 x 2 x 3 copies of a bounded fine row) and summed to month-level cells;
    the time grains are a true hierarchy and come from one grouping-sets
    rollup (month, year, total) of those cells.
    """
    monthly = (
        fine.withColumn("geo", F.explode(_non_null(F.array(
            F.col("geo_name"), F.lit(K.GEO_ALL), F.when(F.col("nested"), F.lit(K.GEO_NESTED))))))
        .withColumn("sex", F.explode(F.array(F.lit(K.SEX_ALL), F.col("ls"))))
        .withColumn("band", F.explode(_non_null(F.array(F.lit(K.BAND_ALL), F.col("xband"), F.col("aband")))))
        .groupBy("geo", "sex", "band", F.trunc("m", "year").alias("y"), "m")
        .agg(*[F.sum(c).alias(c) for c in COUNT_COLS])
    )
    keys = [F.col(k) for k in ("geo", "sex", "band", "y", "m")]
    rolled = monthly.groupingSets(
        [keys, keys[:4], keys[:3]], *keys
    ).agg(F.grouping_id().alias("__gid"), *[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLS])
    gid = F.col("__gid")
    return rolled.select(
        F.when(gid == 0, F.lit(K.GRAIN_MONTH)).when(gid == 1, F.lit(K.GRAIN_YEAR))
        .otherwise(F.lit(K.GRAIN_TOTAL)).alias("grain"),
        F.when(gid == 0, F.col("m")).when(gid == 1, F.col("y")).alias("pkey"),
        "geo", "sex", "band", *COUNT_COLS,
    )


def dense_grid(spark: SparkSession, sf_dir: str, fine: DataFrame) -> DataFrame:
    """Every (grain, period, geo, sex, band) key, with the calendar bounds."""
    names = read_table(spark, sf_dir, "nation", "n_name").select(
        F.col("n_name").alias("geo_name"), F.lit(None).cast("date").alias("m"), F.lit(None).cast("date").alias("max_d")
    )
    bounds_src = names.unionByName(fine.select(F.lit(None).cast("string").alias("geo_name"), "m", "max_d"))
    one = bounds_src.agg(
        F.sort_array(F.collect_set("geo_name")).alias("names"),
        F.min("m").alias("min_m"),
        F.max("m").alias("max_m"),
        F.max("max_d").alias("max_d"),
    )
    months = F.transform(
        F.sequence(F.col("min_m"), F.col("max_m"), F.expr("INTERVAL 1 MONTH")),
        lambda m: F.struct(F.lit(K.GRAIN_MONTH).alias("grain"), m.alias("pkey")),
    )
    years = F.transform(
        F.sequence(F.year("min_m"), F.year("max_m")),
        lambda y: F.struct(F.lit(K.GRAIN_YEAR).alias("grain"), F.make_date(y, F.lit(1), F.lit(1)).alias("pkey")),
    )
    total = F.array(F.struct(F.lit(K.GRAIN_TOTAL).alias("grain"), F.lit(None).cast("date").alias("pkey")))
    # one row per geography first, dealt to all tasks, so that the rest of the grid is generated in parallel
    geos = one.withColumn("geo", F.explode(F.concat(F.col("names"), F.array(*[F.lit(g) for g in K.GEO_EXCLUDED]))))
    return (
        geos.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "geo")
        .withColumn("sex", F.explode(F.array(*[F.lit(s) for s in K.SEXES])))
        .withColumn("band", F.explode(F.array(*[F.lit(b) for b in K.ALL_BAND_LABELS])))
        .withColumn("p", F.explode(F.concat(months, years, total)))
        .select(F.col("p.grain").alias("grain"), F.col("p.pkey").alias("pkey"), "geo", "sex", "band",
                "min_m", "max_d")
    )


def typed_cube(spark: SparkSession, sf_dir: str, fine: DataFrame | None = None) -> DataFrame:
    """The dense, suppressed cube with typed columns (dates, ints, bigint counts)."""
    if fine is None:
        fine = fine_table(spark, sf_dir)
    grid = dense_grid(spark, sf_dir, fine)
    cells = cube_cells(fine)
    keys = ["grain", "geo", "sex", "band"]
    cond = [grid[k] == cells[k] for k in keys] + [grid["pkey"].eqNullSafe(cells["pkey"])]
    j = grid.join(cells, cond, "left").select(
        *[grid[k] for k in ["grain", "pkey", "geo", "sex", "band", "min_m", "max_d"]],
        *[F.coalesce(cells[c], F.lit(0).cast("bigint")).alias(c) for c in COUNT_COLS],
    )
    g = F.col("grain")
    pkey = F.col("pkey")
    period_end = (
        F.when(g == K.GRAIN_MONTH, F.last_day(pkey))
        .when(g == K.GRAIN_YEAR, F.make_date(F.year(pkey), F.lit(12), F.lit(31)))
        .otherwise(F.col("max_d"))
    )
    exempt = F.col("geo") == K.GEO_ALL
    small = {m: (~exempt) & F.col(m).between(K.SUPPRESS_LO, K.SUPPRESS_HI) for m in K.MEASURES}
    any_small = reduce(lambda x, y: x | y, small.values())
    return j.select(
        F.date_add("max_d", K.AS_OF_LAG_DAYS).alias("data_as_of"),
        F.coalesce(pkey, F.col("min_m")).alias("start_date"),
        F.least(period_end, F.col("max_d")).alias("end_date"),
        g.alias("grain"),
        F.when(g != K.GRAIN_TOTAL, F.year(pkey)).alias("year"),
        F.when(g == K.GRAIN_MONTH, F.month(pkey)).alias("month"),
        "geo",
        "sex",
        "band",
        *[F.when(~small[m], F.col(m)).alias(m) for m in K.MEASURES],
        F.when(any_small, F.lit(K.FOOTNOTE)).alias("footnote"),
    )


def render_text(cube: DataFrame) -> DataFrame:
    """Text form of the cube: the 16 source headers, every value a string."""
    def d(c: str) -> Column:
        return F.date_format(c, K.TEXT_DATE_FORMAT)

    def n(c: str) -> Column:
        return F.format_number(F.col(c), 0)

    cols = {
        "Data As Of": d("data_as_of"),
        "Start Date": d("start_date"),
        "End Date": d("end_date"),
        "Group": F.col("grain"),
        "Year": F.col("year").cast("string"),
        "Month": F.col("month").cast("string"),
        "Geo": F.col("geo"),
        "Sex": F.col("sex"),
        "Band": F.col("band"),
        "A Count": n("a"),
        "Total Count": n("total"),
        "B Count": n("b"),
        "A and B Count": n("overlap"),
        "C Count": n("c"),
        "A, B, or C Count": n("union_cnt"),
        "Footnote": F.col("footnote"),
    }
    return cube.select(*[v.alias(k) for k, v in cols.items()])
