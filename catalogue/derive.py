"""Flow, lookup and page tables derived from the driver's tables (rules: FIXTURES.md, section 2).

Each supplier nation exports to each customer nation what its line items sold there; the customer
nation reports the same deliveries as imports at a higher value. The tables are written once per
session and input folder to the scratch folder, in the layout the library's readers expect.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.operators import valuation as V
from mirrorflow.plans.training import Lookups
from mirrorflow.sources import schemas, tables
from mirrorflow.sources.scratch import scratch_path

CUTOVER_YEAR = 1998
RTA_FROM = 1997

# Reporters whose names need the clean-up rules, besides the nations.
SPECIAL_REPORTERS = (
    "Fmr Ethiopia (until 1992)",
    "USA (before 1981)",
    "Bolivia (Plurinational State of)",
    "Fmr Sudan ",
    " Czechia",
    "Atlantis (lost)",
    "Viet Nam (united)",
    "Romania",
    "Yugoslavia",
)
EXTRA_CODES = (("Viet Nam", "VNM"), ("Romania", "ROM"), ("Yugoslavia", "YUG"))

_memo: dict[tuple[str, str], Fixture] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(prefix: str, number: Column, digits: int) -> Column:
    """``prefix`` and the number, with zeros up to ``digits``; nulls and signs as the formatter has them."""
    short = F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))
    return (
        F.when(number >= 10**digits, F.concat(F.lit(prefix), number.cast("string")))
        .when(number >= 0, short)
        .otherwise(F.format_string(f"{prefix}%0{digits}d", number))
    )


def iso(key: Column | str) -> Column:
    return _numbered("n", F.col(key) if isinstance(key, str) else key, 2)


def hs(prefix: str, index: Column) -> Column:
    return _numbered(prefix, index.cast("long"), 4)


def commodity_index(partkey: str) -> Column:
    """20 commodities per 2,000 parts, so that commodities grow with the data."""
    p = F.col(partkey)
    return (F.floor(p / 2000) * 20 + p % 20).cast("long")


# --- flows ------------------------------------------------------------------------------------


def trade_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per year, supplier nation, customer nation and commodity.

    Line items get their supplier's nation first, by broadcast where the suppliers are few, and then meet
    their order's nation on the order key; AQE splits a hot key of either join. Cells are about as many as
    line items, so there is one exchange of sums, formed in part before it.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("cn"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("sn"))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        commodity_index("l_partkey").alias("kk"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_extendedprice").alias("v"),
        F.col("l_quantity").alias("q"),
        F.col("l_tax").alias("t"),
        F.col("l_discount").alias("d"),
    )
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "cn")
    sold = items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")
    sold = sold.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))

    v, q = F.col("v"), F.col("q")
    exported, imported, skipped = F.col("ln") != 3, F.col("ln") != 5, F.col("ln") == 3
    sums = {
        "e_v": F.when(exported, v),
        "e_q": F.when(exported, q),
        "re_v": F.when(exported & (F.col("rf") == "R"), v),
        "re_q": F.when(exported & (F.col("rf") == "R"), q),
        "i_v": F.when(imported, v),
        "i_c": F.when(imported, v * (1 + F.col("t") + 2 * F.col("d"))),
        "i_q": F.when(imported, q * (1 - F.col("d") * 0.5)),
        "ri_v": F.when(imported & (F.col("rf") == "A"), v),
        "ri_q": F.when(imported & (F.col("rf") == "A"), q),
        "x_v": F.when(skipped, v),
        "x_q": F.when(skipped, q),
    }
    return sold.groupBy("year", "sn", "cn", "kk").agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def flow_rows(cells: DataFrame) -> DataFrame:
    """One row per report; reports without any line item are absent."""
    k = F.col("kk") % 20
    exporter, importer = F.col("exporter"), F.col("importer")
    seller = F.col("sn") < 23
    mark_up = F.col("i_c") + F.lit(0.15) * (1 + (F.col("sn") + F.col("cn")) % 3) * F.col("i_v")

    def report(
        level: Column | int, flow: str, reporter: Column, partner: Column, value: Column, qty: Column
    ) -> Column:
        return F.struct(
            (level if isinstance(level, Column) else F.lit(level)).cast("int").alias("aggregate_level"),
            F.lit(flow).alias("trade_flow"),
            reporter.alias("reporter_iso"),
            partner.alias("partner_iso"),
            F.round(value, 6).alias("trade_value_usd"),
            F.round(qty, 6).alias("_q"),
        )

    odd_partner = (
        F.when(F.col("kk") % 4 == 1, codes.EXCLUDED_AREAS[0])
        .when(F.col("kk") % 4 == 2, codes.EXCLUDED_AREAS[1])
        .when(F.col("kk") % 4 == 3, importer)
    )
    odd_level = F.when(F.col("kk") % 4 == 3, 4).otherwise(6)
    reports = F.array(
        report(6, "export", exporter, importer, F.when(seller, F.col("e_v")), 200 * F.col("e_q")),
        report(6, "import", importer, exporter, mark_up, 200 * F.col("i_q")),
        report(6, "re-export", exporter, importer, F.when(seller, 0.3 * F.col("re_v")), 60 * F.col("re_q")),
        report(6, "re-import", importer, exporter, 0.1 * F.col("ri_v"), 20 * F.col("ri_q")),
        report(odd_level, "noise", exporter, odd_partner, F.col("x_v"), 200 * F.col("x_q")),
    )
    unit = (
        F.when(F.col("_k") % 10 == 7, "number of items")
        .when(F.col("_k") % 10 == 3, codes.ELECTRICITY)
        .when(F.col("_k") % 10 == 9, "no quantity")
        .otherwise(codes.KILOGRAMS)
    )
    return (
        cells.withColumns({"exporter": iso("sn"), "importer": iso("cn"), "commodity_code": hs("01", F.col("kk"))})
        .select("year", "commodity_code", k.alias("_k"), F.explode(reports).alias("r"))
        .select("year", "commodity_code", "_k", "r.*")
        .filter(F.col("trade_value_usd").isNotNull())
        .select(
            "commodity_code",
            "partner_iso",
            "trade_value_usd",
            unit.alias("qty_unit"),
            F.when(F.col("_k") % 10 == 9, F.lit(0.0)).otherwise(F.col("_q")).alias("qty"),
            F.when(F.col("_k") != 9, F.col("_q")).alias("netweight_kg"),
            "aggregate_level",
            "trade_flow",
            F.col("year").cast("int").alias("year"),
            "reporter_iso",
        )
    )


TREES = ("hs02", "hs12", "noise")


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Tasks keep the files of up to 200 folders open, where they would else sort their rows by folder and spill.

    A task with more folders sorts what is left.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "200")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_flows(spark: SparkSession, sf_dir: str, root: str) -> None:
    """One tree per classification, and the rows that only the flow filter is tried on.

    As in the field, each classification's tree also holds years the other one should supply. Rows are
    written where the sums are formed: there are as many files as those tasks for each folder, and no
    exchange of reports, of which there are several per sum.
    """
    noise, year = F.col("trade_flow") == "noise", F.col("year")
    trees = F.array_compact(
        F.array(
            F.when(~noise & (year <= CUTOVER_YEAR), TREES[0]),
            F.when(~noise & (year >= CUTOVER_YEAR - 1), TREES[1]),
            F.when(noise, TREES[2]),
        )
    )
    parts = ["tree", "aggregate_level", "trade_flow", "year"]
    rows = flow_rows(trade_cells(spark, sf_dir))
    with _unsorted(spark):
        rows.select("*", F.explode(trees).alias("tree")).write.partitionBy(*parts).parquet(root)


# --- lookups ----------------------------------------------------------------------------------


def nation_pairs(nation: DataFrame) -> DataFrame:
    """Ordered pairs of nations with both regions."""
    last = nation.agg(F.max("n_nationkey")).first()[0] or 0
    a = nation.select(
        F.col("n_nationkey").alias("a"),
        F.col("n_regionkey").alias("ra"),
        F.explode(F.sequence(F.lit(0), F.lit(last))).alias("b"),
    )
    b = nation.select(F.col("n_nationkey").alias("b"), F.col("n_regionkey").alias("rb"))
    return a.join(b, "b")


def ship_years(items: DataFrame) -> Column:
    """The calendar years with a shipment, as an array."""
    found = items.select(F.year("l_shipdate").alias("y")).dropna().distinct().collect()
    return F.array(*[F.lit(y) for y in sorted(r["y"] for r in found)]).cast("array<int>")


def distances(nation: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    near = (F.col("ra") == F.col("rb")) & (F.abs(a - b) <= 5)
    far = F.when(F.col("ra") != F.col("rb"), 1500).otherwise(0)
    return nation_pairs(nation).filter(a != 22).select(
        F.upper(iso(a)).alias("iso_o"),
        F.upper(iso(b)).alias("iso_d"),
        (F.lit(200) + 350 * F.abs(a - b) + far).cast("double").alias("dist"),
        near.cast("int").alias("contig"),
        (a * b % 7 == 0).cast("int").alias("colony"),
        ((a + b) % 4 == 0).cast("int").alias("comlang_off"),
    )


def countries(nation: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    times = F.when(n % 4 == 0, 2).otherwise(1)
    return nation.select(n, F.explode(F.sequence(F.lit(1), times)).alias("_i")).select(
        F.upper(iso(n)).alias("iso3"), (n % 5 == 0).cast("int").alias("landlocked")
    )


def hs_crosswalk(part: DataFrame) -> DataFrame:
    """Commodities 18 and 19 of each block have no counterpart; every third one has two."""
    kk = commodity_index("p_partkey")
    k = F.col("kk") % 20
    target = F.col("kk") - k + F.floor(k / 2)
    targets = F.when(k % 3 == 0, F.array(target, target + 1)).otherwise(F.array(target))
    return (
        part.select(kk.alias("kk"))
        .filter(k < 18)
        .distinct()
        .select(hs("01", F.col("kk")).alias("hs02"), F.explode(targets).alias("_t"))
        .select("hs02", hs("02", F.col("_t")).alias("hs12"))
    )


def rtas(nation: DataFrame, years: Column) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return (
        nation_pairs(nation)
        .filter((a < b) & ((a + b) % 3 == 0))
        .select(
            F.explode(F.filter(years, lambda y: y >= RTA_FROM)).alias("year"),
            iso(a).alias("country1"),
            iso(b).alias("country2"),
            F.lit(1).alias("rta"),
        )
    )


def country_codes(nation: DataFrame) -> DataFrame:
    spark = nation.sparkSession
    own = nation.select(
        F.col("n_name").alias("country_name_english"), F.upper(iso("n_nationkey")).alias("iso3_digit_alpha")
    )
    return own.unionByName(spark.createDataFrame(list(EXTRA_CODES), schemas.COUNTRY_CODES))


def valuation_raw(customer: DataFrame, nation: DataFrame, years: Column) -> DataFrame:
    """Notes of the customers' nations and of the special reporters, some rows repeated."""
    note = "struct<reporter: string, trade_flow: string, valuation: string, r: int>"

    def row(reporter: Column, flow: str, value: Column, r: Column) -> Column:
        return F.struct(
            reporter.alias("reporter"), F.lit(flow).alias("trade_flow"),
            value.cast("string").alias("valuation"), r.cast("int").alias("r"),
        )

    n, name = F.col("n_nationkey"), F.col("n_name")
    nothing = F.lit(None).cast(note)
    imports = row(name, "Import", F.when(n % 6 == 0, "FOB").otherwise("CIF"), n)
    notes = F.array(
        row(name, "Export", F.lit("FOB"), n),
        F.when(n % 6 != 1, imports).otherwise(nothing),
        F.when((n % 6 != 1) & (n % 4 == 0), imports).otherwise(nothing),
        F.when(n % 7 == 3, row(name, "Import", F.lit("FOB"), n + 200)).otherwise(nothing),
    )
    own = (
        customer.select("c_nationkey")
        .distinct()
        .join(nation, F.col("c_nationkey") == n)
        .select(F.explode(notes).alias("e"))
        .filter(F.col("e").isNotNull())
        .select("e.*")
    )
    names = F.array(*[F.lit(s) for s in SPECIAL_REPORTERS])
    at = F.col("c_custkey") % len(SPECIAL_REPORTERS)
    special = (
        customer.select(at.cast("int").alias("at"))
        .distinct()
        .select(
            F.get(names, F.col("at")).alias("reporter"), F.lit("Import").alias("trade_flow"),
            F.when(F.col("at") % 2 == 0, "CIF").otherwise("FOB").alias("valuation"),
            (F.col("at") + 100).alias("r"),
        )
    )
    return own.unionByName(special).select("*", F.explode(years).alias("y"))


# --- all of it --------------------------------------------------------------------------------


class Fixture:
    """Readers of the derived tables; each is written when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir
        self._root = scratch_path(spark, "fixture")

    def _given(self, name: str) -> DataFrame:
        return table(self._spark, self._dir, name)

    def _lookup(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self._root}/{name}")
        return tables.read_lookup(self._spark, name, f"{self._root}/{name}")

    @cached_property
    def _trees(self) -> dict[str, str]:
        root = f"{self._root}/flows"
        write_flows(self._spark, self._dir, root)
        return {t: f"{root}/tree={t}" for t in TREES}

    @property
    def old_tree(self) -> str:
        return self._trees["hs02"]

    @property
    def new_tree(self) -> str:
        return self._trees["hs12"]

    @cached_property
    def flows(self) -> DataFrame:
        return tables.read_flows(self._spark, self.old_tree, self.new_tree, CUTOVER_YEAR)

    @cached_property
    def noise(self) -> DataFrame:
        rows = tables.read_flow_tree(self._spark, self._trees["noise"])
        return rows.withColumn("trade_flow", F.lit("export"))

    @cached_property
    def _years(self) -> Column:
        return ship_years(self._given("lineitem"))

    @cached_property
    def hs_crosswalk(self) -> DataFrame:
        return self._lookup("hs_crosswalk", hs_crosswalk(self._given("part")))

    @cached_property
    def country_codes(self) -> DataFrame:
        return self._lookup("country_codes", country_codes(self._given("nation")))

    @cached_property
    def valuation_raw(self) -> DataFrame:
        raw = valuation_raw(self._given("customer"), self._given("nation"), self._years)
        return self._lookup("valuation_raw", raw)

    @cached_property
    def lookups(self) -> Lookups:
        nation = self._given("nation")
        return Lookups(
            distances=self._lookup("distances", distances(nation)),
            countries=self._lookup("countries", countries(nation)),
            hs_crosswalk=self.hs_crosswalk,
            rtas=self._lookup("rtas", rtas(nation, self._years)),
            valuation=self._lookup("valuation", V.clean_valuation(self.valuation_raw, self.country_codes)),
        )


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    """The derived tables for ``sf_dir``, the same object for all calls in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _memo:
        _memo[key] = Fixture(spark, sf_dir)
    return _memo[key]
