"""The ten analyses over the processed table (A1-A10).

Each analysis function is one aggregation (partial + final hash aggregate,
so a hot group is pre-combined map-side) or one filtered top-k. Money
columns are exact DECIMAL sums rounded half up (see ``functions.exprs`` for
amounts that no DECIMAL holds); rates are DECIMAL percentages shown as DOUBLE.

When all ten are wanted (the workflow), A1-A9 are read off one *analysis
cube* instead of nine scans of the table:

* a ``GROUPING SETS`` aggregate over the low-cardinality groupings (all,
  country, currency, category, time slot, hour, weekend, channel) with
  fixed-width buffers only, so it is a hash aggregate whose partial result
  per task has a handful of rows;
* a *customer profile*, one aggregate per (customer, country, weekend,
  account type) with the four sums the customer-level results need. This is
  the one customer-level shuffle; distinct customers per group, the largest
  account type and the customer totals are grouping sets over the profile,
  whose rows grow with the customers, not with the transactions.

Both are unioned into one cube DataFrame (``grouping_set`` names the set).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import exprs as X
from ..functions import labels as L
from .rules import alert_condition


def _n() -> F.Column:
    return F.count(F.lit(1))


def _approved() -> F.Column:
    return X.count_if(F.col("status") == L.STATUS_APPROVED)


def _declined() -> F.Column:
    return X.count_if(F.col("status") == L.STATUS_DECLINED)


# Ids of one bitmap: eight 64-bit words
BITMAP_WORDS = 8
ID_SHIFT = 9


def _bitmap_words() -> list[Column]:
    """The exact bitmap of the customers in a group of ids that agree above
    their lowest nine bits: one ``bit_or`` a word, a fixed-width buffer, so the
    aggregate stays a hash aggregate (``bitmap_construct_agg`` keeps its buffer
    as binary, which makes Spark sort every row of every task)."""
    slot = F.shiftright("customer_id", 6).bitwiseAND(F.lit(BITMAP_WORDS - 1))
    bit = F.expr("shiftleft(1L, cast(customer_id & 63 as int))")
    return [F.bit_or(F.when(slot == k, bit)).alias(f"_w{k}") for k in range(BITMAP_WORDS)]


# how partial measures of the same name are put together; all others are summed
MERGES = {"amount_min": F.min, "amount_max": F.max, "ts_min": F.min, "ts_max": F.max}


def merged(name: str) -> Column:
    return MERGES.get(name, F.sum)(name).alias(name)


def with_unique_customers(df: DataFrame, keys: list[str], measures: list[Column]) -> DataFrame:
    """``measures`` (aliased, mergeable by ``MERGES``) per ``keys``, and
    ``unique_customers`` (distinct non-NULL customers), from one scan.

    Customers are collected as exact bitmaps: the first aggregate is by
    (keys, id without its lowest nine bits) and holds 512 customers a row as
    bits, the second adds the measures and counts the bits. Where ids are
    numbers from a sequence, a row of the shuffle stands for up to 512
    customers and the reducers hold no list of them; where ids are spread
    thinly over 64 bits, a row holds one, as in a distinct of (keys, customer)
    but wider. Combined in every task, so a hot group or customer does not
    reach one task whole; an empty table gives one row without keys.
    """
    names = [f.name for f in df.groupBy().agg(*measures).schema.fields]
    block = F.shiftright(F.col("customer_id"), ID_SHIFT).alias("_block")
    blocks = df.groupBy(*keys, block).agg(*measures, *_bitmap_words())
    customers = reduce(lambda x, y: x + y, [F.coalesce(F.bit_count(f"_w{k}"), F.lit(0)) for k in range(BITMAP_WORDS)])
    out = blocks.groupBy(*keys).agg(
        *[merged(n) for n in names], F.coalesce(F.sum(customers), F.lit(0)).cast("bigint").alias("unique_customers"))
    return out


def summary_stats(df: DataFrame) -> DataFrame:
    """A1: one row of overall figures."""
    own = with_unique_customers(df, [], _measures(
        "n", "amount_sum", "amount_rest", "amount_n", "amount_min", "amount_max", "approved", "declined"))
    return own.select(
        _count("n").alias("total_transactions"), "unique_customers",
        _total().alias("total_amount"), _avg().alias("avg_amount"),
        X.round2(F.col("amount_min")).alias("min_amount"), X.round2(F.col("amount_max")).alias("max_amount"),
        _count("approved").alias("approved"), _count("declined").alias("declined"),
        _rate("approved").alias("approval_rate"))


def by_country(df: DataFrame) -> DataFrame:
    """A2: per country, largest total first."""
    own = with_unique_customers(df, ["country"], _measures("n", "amount_sum", "amount_rest", "amount_n", "approved"))
    return own.select(
        "country", F.col("n").alias("total_transactions"), _total().alias("total_amount"),
        _avg().alias("avg_amount"), "unique_customers", _rate("approved").alias("approval_rate"),
    ).orderBy(F.col("total_amount").desc_nulls_last(), F.col("country").asc_nulls_last())


def _simple_group(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        _n().alias("total_transactions"),
        X.money_total("amount").alias("total_amount"),
        X.money_avg("amount").alias("avg_amount"),
    )


def by_currency(df: DataFrame) -> DataFrame:
    """A3: per currency, most transactions first."""
    return _simple_group(df, "currency").orderBy(
        F.col("total_transactions").desc(), F.col("currency").asc_nulls_last())


def _with_share(g: DataFrame) -> DataFrame:
    """Share of all rows. The total is a scalar subquery over the same
    aggregate: no task holds all categories, however many there are. The
    subquery reads the amounts as well, since only then is its plan below the
    total the one of ``g`` and the exchange reused: one scan."""
    whole = g.agg(F.struct(F.sum("total_transactions").alias("n"), F.max("total_amount"), F.max("avg_amount")))
    return g.withColumn("percentage", X.pct(F.col("total_transactions"), whole.scalar()["n"])).orderBy(
        F.col("total_transactions").desc(), F.col("category").asc_nulls_last())


def by_category(df: DataFrame) -> DataFrame:
    """A4: per category with its share of all rows."""
    return _with_share(_simple_group(df, "category"))


def by_time_slot(df: DataFrame) -> DataFrame:
    """A5: per time slot in day order."""
    return (
        df.groupBy("time_slot").agg(
            _n().alias("total_transactions"),
            X.money_total("amount").alias("total_amount"),
            X.money_avg("amount").alias("avg_amount"),
            _declined().alias("declined_count"),
        )
        .orderBy(X.slot_rank("time_slot").asc_nulls_last(), "time_slot")
    )


def _top_customers(per_customer: DataFrame, n: int) -> DataFrame:
    """Top-n of per-customer sums (``n, amount_sum, amount_n, declined,
    account_type``) by rounded spend, ties by customer id."""
    return (
        per_customer.select(
            "customer_id", F.col("n").alias("total_transactions"),
            _total().alias("total_spent"), _avg().alias("avg_transaction"),
            "account_type", F.col("declined").alias("declined_count"),
        )
        .orderBy(F.col("total_spent").desc_nulls_last(), F.col("customer_id").asc_nulls_last())
        .limit(n)
    )


def top_customers(df: DataFrame, n: int = 20) -> DataFrame:
    """Top-n customers by rounded spend (ties: customer id).

    The customer aggregate has fixed-width buffers only (a string maximum in
    it would make Spark sort every row of every task); the ``n`` rows that
    remain are broadcast to look their largest account type up. One customer
    shuffle, whatever the number of account types.
    """
    sums = df.groupBy("customer_id").agg(*_measures("n", "amount_sum", "amount_rest", "amount_n", "declined"))
    order = [F.col("total_spent").desc_nulls_last(), F.col("customer_id").asc_nulls_last()]
    top = sums.select(
        F.col("customer_id").alias("_c"), F.col("n").alias("total_transactions"), _total().alias("total_spent"),
        _avg().alias("avg_transaction"), F.col("declined").alias("declined_count"),
    ).orderBy(F.col("total_spent").desc_nulls_last(), F.col("_c").asc_nulls_last()).limit(n)
    rows = df.select("customer_id", "account_type").join(
        F.broadcast(top), F.col("customer_id").eqNullSafe(F.col("_c")))     # n rows are broadcast
    keys = ["customer_id", "total_transactions", "total_spent", "avg_transaction", "declined_count"]
    types = rows.groupBy(*keys, "account_type").agg(F.lit(1))
    return types.groupBy(*keys).agg(F.max("account_type").alias("account_type")).select(
        "customer_id", "total_transactions", "total_spent", "avg_transaction", "account_type", "declined_count",
    ).orderBy(*order).limit(n)


def fraud_rate_by_hour(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Share of rows with a high risk score, per hour."""
    high = X.count_if(F.col("risk_score") >= t.alert_score)
    return (
        df.groupBy("hour").agg(
            _n().alias("total_transactions"),
            high.alias("high_risk_count"),
            X.pct(high, _n()).alias("high_risk_rate"),
        )
        .orderBy(F.col("hour").asc_nulls_last())
    )


def _weekend_label(g: DataFrame) -> DataFrame:
    label = F.when(F.col("is_weekend"), L.PERIOD_WEEKEND).otherwise(L.PERIOD_WEEKDAY)
    return g.orderBy("is_weekend").select(
        label.alias("period_type"), "total_transactions", "total_amount",
        "avg_amount", "unique_customers")


def weekend_vs_weekday(df: DataFrame) -> DataFrame:
    """Weekend against weekday."""
    own = with_unique_customers(df, ["is_weekend"], _measures("n", "amount_sum", "amount_rest", "amount_n"))
    return _weekend_label(own.select(
        "is_weekend", F.col("n").alias("total_transactions"), _total().alias("total_amount"),
        _avg().alias("avg_amount"), "unique_customers"))


def by_channel(df: DataFrame) -> DataFrame:
    """Per channel, most transactions first."""
    return (
        df.groupBy("channel").agg(
            _n().alias("total_transactions"),
            X.money_total("amount").alias("total_amount"),
            X.money_avg("amount").alias("avg_amount"),
            X.pct(_approved(), _n()).alias("approval_rate"),
        )
        .orderBy(F.col("total_transactions").desc(), F.col("channel").asc_nulls_last())
    )


def high_value_declined(df: DataFrame, min_amount: float = 1000.0, n: int = 20) -> DataFrame:
    """A10: top-n declined transactions above ``min_amount``; the predicate
    reaches the Parquet scan."""
    return (
        df.filter((F.col("status") == L.STATUS_DECLINED) & (F.col("amount") > min_amount))
        .select("transaction_id", "customer_id", "country", "amount", "currency",
                "category", "timestamp", "risk_score")
        .orderBy(F.col("amount").desc(), "transaction_id")
        .limit(n)
    )


ANALYSES = {
    "summary_stats": summary_stats,
    "by_country": by_country,
    "by_currency": by_currency,
    "by_category": by_category,
    "by_time_slot": by_time_slot,
    "top_customers": top_customers,
    "fraud_rate_by_hour": fraud_rate_by_hour,
    "weekend_vs_weekday": weekend_vs_weekday,
    "by_channel": by_channel,
    "high_value_declined": high_value_declined,
}


# ------------------------------------------------------------ analysis cube

CUBE_DIMS = ("country", "currency", "category", "time_slot", "hour", "is_weekend",
             "channel", "customer_id", "account_type")
# grouping sets over the transactions (few groups each)
TABLE_SETS: dict[str, tuple[str, ...]] = {
    "all": (),
    "country": ("country",),
    "currency": ("currency",),
    "category": ("category",),
    "time_slot": ("time_slot",),
    "hour": ("hour",),
    "weekend": ("is_weekend",),
    "channel": ("channel",),
}
# grouping sets over the customer profile (one group per customer or pair)
PROFILE_KEYS = ("customer_id", "country", "is_weekend", "account_type")
PROFILE_SETS: dict[str, tuple[str, ...]] = {
    "customer": ("customer_id",),
    "customer_account": ("customer_id", "account_type"),
    "country_customer": ("country", "customer_id"),
    "weekend_customer": ("is_weekend", "customer_id"),
}
PROFILE_MEASURES = ("n", "amount_sum", "amount_rest", "amount_n", "declined")
MEASURES = ("n", "amount_sum", "amount_rest", "amount_n", "amount_min", "amount_max", "approved",
            "declined", "fraud", "pending", "high_risk", "alerts", "ts_min", "ts_max")
# exact money sums of any number of rows; what no DECIMAL holds is in amount_rest
SUM_TYPE = "decimal(38,10)"


def _table_measures(t: Thresholds) -> list[Column]:
    status, amount = F.col("status"), F.col("amount")
    return [
        _n().alias("n"),
        F.sum(X.exact_part(amount)).cast(SUM_TYPE).alias("amount_sum"),
        F.sum(X.rest_part(amount)).alias("amount_rest"),
        F.count(amount).alias("amount_n"),
        F.min(amount).alias("amount_min"),
        F.max(amount).alias("amount_max"),
        _approved().alias("approved"),
        _declined().alias("declined"),
        X.count_if(status == L.STATUS_FRAUD).alias("fraud"),
        X.count_if(status == L.STATUS_PENDING).alias("pending"),
        X.count_if(F.col("risk_score") >= t.alert_score).alias("high_risk"),
        X.count_if(alert_condition(t)).alias("alerts"),
        F.min("timestamp_dt").alias("ts_min"),
        F.max("timestamp_dt").alias("ts_max"),
    ]


def _measures(*names: str, t: Thresholds = Thresholds()) -> list[Column]:
    """Measures of the table by name."""
    own = dict(zip(MEASURES, _table_measures(t)))
    return [own[n] for n in names]


def _profile_sums() -> list[Column]:
    return _measures(*PROFILE_MEASURES)


def customer_profile(df: DataFrame) -> DataFrame:
    """Per (customer, country, weekend, account type): rows, exact amount
    sum, non-NULL amounts and declined rows. Every customer-level result is
    read off these rows, so the transactions are shuffled by customer once."""
    return df.groupBy(*PROFILE_KEYS).agg(*_profile_sums())


def _grouping_sets(df: DataFrame, sets: dict[str, tuple[str, ...]],
                   measures: list[Column]) -> DataFrame:
    """``GROUPING SETS`` aggregate labelled by set name (``grouping_set``)."""
    names = list(sets)
    dims = [d for d in CUBE_DIMS if any(d in sets[s] for s in names)]
    if len(names) == 1:
        only = sets[names[0]]
        agg = df.groupBy(*only).agg(*measures)
        return agg.select(
            F.lit(names[0]).alias("grouping_set"),
            *[F.col(d) if d in only else F.lit(None).alias(d) for d in dims],
            *[c for c in agg.columns if c not in only])
    # grouping_id(): bit i (from the left) is 1 when dims[i] is not grouped
    width = len(dims)
    gid = {s: sum(1 << (width - 1 - i) for i, d in enumerate(dims) if d not in sets[s])
           for s in names}
    label = reduce(lambda acc, s: acc.when(F.col("_gid") == gid[s], s),
                   names[1:], F.when(F.col("_gid") == gid[names[0]], names[0]))
    agg = df.groupingSets([list(sets[s]) for s in names], *dims).agg(
        F.grouping_id().alias("_gid"), *measures)
    return agg.select(label.alias("grouping_set"), *[c for c in agg.columns if c != "_gid"])


def analysis_cube(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Every grouping A1-A9 and the report summary need, from two
    aggregations of the processed table (see the module docstring).

    Columns: ``grouping_set``, ``CUBE_DIMS`` (NULL where a column is not
    grouped in the row's set; a NULL in a grouped column is a NULL in the
    data), then ``MEASURES`` (only the four profile measures are filled in
    the customer sets).
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    table = _grouping_sets(df, TABLE_SETS, _table_measures(t))
    kinds = {"amount_sum": SUM_TYPE, "amount_rest": "double"}
    sums = [F.sum(c).cast(kinds.get(c, "bigint")).alias(c) for c in PROFILE_MEASURES]
    customers = _grouping_sets(customer_profile(df), PROFILE_SETS, sums)

    def aligned(part: DataFrame) -> DataFrame:
        have = set(part.columns)
        types = {f.name: f.dataType for f in table.schema.fields}
        return part.select(
            "grouping_set",
            *[F.col(d) if d in have else F.lit(None).cast(schema[d]).alias(d)
              for d in CUBE_DIMS],
            *[F.col(m) if m in have else F.lit(None).cast(types[m]).alias(m)
              for m in MEASURES],
        )

    return aligned(table).unionByName(aligned(customers))


# ------------------------------------------------- results read off the cube

def _rows(cube: DataFrame, name: str) -> DataFrame:
    return cube.filter(F.col("grouping_set") == name)


def _of(name: str, c: str) -> Column:
    """``c`` of the one row a group has in set ``name`` (an aggregate)."""
    return F.max(F.when(F.col("grouping_set") == name, F.col(c)))


def _customers_in(pairs: str) -> Column:
    """Distinct non-NULL customers: rows of the ``pairs`` set (an aggregate)."""
    return X.count_if((F.col("grouping_set") == pairs) & F.col("customer_id").isNotNull())


def _total() -> Column:
    return X.round2(X.joined(F.col("amount_sum"), F.col("amount_rest")))


def _avg() -> Column:
    return X.round2(X.joined(F.col("amount_sum"), F.col("amount_rest")) / F.col("amount_n").cast("double"))


def _count(c: str) -> Column:
    """A count that is 0, not NULL, for an empty table."""
    return F.coalesce(F.col(c), F.lit(0)).alias(c)


def _rate(c: str) -> Column:
    return X.pct(F.col(c), F.col("n"))


def _money(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, F.col("n").alias("total_transactions"),
                       _total().alias("total_amount"), _avg().alias("avg_amount"))


def _with_customers(cube: DataFrame, key: str, name: str, pairs: str) -> DataFrame:
    """Measures of set ``name`` per ``key`` and its distinct customers."""
    return cube.filter(F.col("grouping_set").isin(name, pairs)).groupBy(key).agg(
        *[_of(name, m).alias(m) for m in ("n", "amount_sum", "amount_rest", "amount_n", "approved")],
        _customers_in(pairs).alias("unique_customers"),
    )


def summary_from_cube(cube: DataFrame) -> DataFrame:
    """A1 (one row, also when the table is empty)."""
    rows = cube.filter(F.col("grouping_set").isin("all", "customer"))
    counts = ("n", "approved", "declined")
    wide = rows.agg(
        *[F.coalesce(_of("all", m), F.lit(0)).alias(m) for m in counts],
        *[_of("all", m).alias(m) for m in ("amount_sum", "amount_rest", "amount_n", "amount_min",
                                            "amount_max")],
        _customers_in("customer").alias("unique_customers"),
    )
    return wide.select(
        F.col("n").alias("total_transactions"), "unique_customers",
        _total().alias("total_amount"), _avg().alias("avg_amount"),
        X.round2(F.col("amount_min")).alias("min_amount"),
        X.round2(F.col("amount_max")).alias("max_amount"),
        "approved", "declined", _rate("approved").alias("approval_rate"),
    )


def by_country_from_cube(cube: DataFrame) -> DataFrame:
    g = _with_customers(cube, "country", "country", "country_customer")
    return g.select(
        "country", F.col("n").alias("total_transactions"), _total().alias("total_amount"),
        _avg().alias("avg_amount"), "unique_customers", _rate("approved").alias("approval_rate"),
    ).orderBy(F.col("total_amount").desc_nulls_last(), F.col("country").asc_nulls_last())


def by_currency_from_cube(cube: DataFrame) -> DataFrame:
    return _money(_rows(cube, "currency"), "currency").orderBy(
        F.col("total_transactions").desc(), F.col("currency").asc_nulls_last())


def by_category_from_cube(cube: DataFrame) -> DataFrame:
    return _with_share(_money(_rows(cube, "category"), "category"))


def by_time_slot_from_cube(cube: DataFrame) -> DataFrame:
    return _rows(cube, "time_slot").select(
        "time_slot", F.col("n").alias("total_transactions"), _total().alias("total_amount"),
        _avg().alias("avg_amount"), F.col("declined").alias("declined_count"),
    ).orderBy(X.slot_rank("time_slot").asc_nulls_last(), "time_slot")


def top_customers_from_cube(cube: DataFrame, n: int = 20) -> DataFrame:
    rows = cube.filter(F.col("grouping_set").isin("customer", "customer_account"))
    per_customer = rows.groupBy("customer_id").agg(
        *[_of("customer", m).alias(m) for m in PROFILE_MEASURES],
        _of("customer_account", "account_type").alias("account_type"),
    )
    return _top_customers(per_customer, n)


def fraud_rate_by_hour_from_cube(cube: DataFrame) -> DataFrame:
    return _rows(cube, "hour").select(
        "hour", F.col("n").alias("total_transactions"),
        F.col("high_risk").alias("high_risk_count"), _rate("high_risk").alias("high_risk_rate"),
    ).orderBy(F.col("hour").asc_nulls_last())


def weekend_vs_weekday_from_cube(cube: DataFrame) -> DataFrame:
    g = _with_customers(cube, "is_weekend", "weekend", "weekend_customer")
    return _weekend_label(g.select(
        "is_weekend", F.col("n").alias("total_transactions"), _total().alias("total_amount"),
        _avg().alias("avg_amount"), "unique_customers"))


def by_channel_from_cube(cube: DataFrame) -> DataFrame:
    return _rows(cube, "channel").select(
        "channel", F.col("n").alias("total_transactions"), _total().alias("total_amount"),
        _avg().alias("avg_amount"), _rate("approved").alias("approval_rate"),
    ).orderBy(F.col("total_transactions").desc(), F.col("channel").asc_nulls_last())


FROM_CUBE = {
    "summary_stats": summary_from_cube,
    "by_country": by_country_from_cube,
    "by_currency": by_currency_from_cube,
    "by_category": by_category_from_cube,
    "by_time_slot": by_time_slot_from_cube,
    "top_customers": top_customers_from_cube,
    "fraud_rate_by_hour": fraud_rate_by_hour_from_cube,
    "weekend_vs_weekday": weekend_vs_weekday_from_cube,
    "by_channel": by_channel_from_cube,
}


def analyses_from_cube(cube: DataFrame, table: DataFrame) -> dict[str, DataFrame]:
    """All ten results: A1-A9 read off the cube, A10 from the table."""
    out = {name: derive(cube) for name, derive in FROM_CUBE.items()}
    out["high_value_declined"] = high_value_declined(table)
    return {name: out[name] for name in ANALYSES}
