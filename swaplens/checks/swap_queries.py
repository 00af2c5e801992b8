"""Swap records, prices, enrichment, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swaplens.checks import sql as S
from swaplens.checks.registry import query
from swaplens.functions.money import usd_volume
from swaplens.functions.rounding import round_scaled
from swaplens.operators import aggregate, clean, enrich
from swaplens.plans.scale import run_dir
from swaplens.sources import adapters as A
from swaplens.sources import files, layout, parts, prices, search, state, swaps

SWAP_COLUMNS = ["txHash", "blockNumber", "timestamp", "token0", "token1", "amount0", "amount1", "sqrtPriceX96"]
YEAR = 365 * 24 * 60
NOW = 978307200  # 2001-01-01


def _exact(enriched: DataFrame) -> DataFrame:
    """Volumes as decimals, so that sums do not depend on the order of the rows."""
    return enriched.withColumn("usdVolume", F.col("usdVolume").cast("decimal(28,6)"))


def enriched_swaps(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich_swaps(A.swaps(spark, d), A.prices(spark, d), A.decimals(spark, d), A.stables(spark, d))


# Sources, sinks, state


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Every swap as a response page of its own; line 2 has no block, line 3 a bad timestamp, line 5 is an error page."""
    token = lambda name: F.struct(F.lit("T").alias("symbol"), F.col(name).alias("id"))
    line = F.col("line")
    swap = F.struct(
        F.col("id"),
        F.struct(F.concat(F.lit("tx-"), "id").alias("id")).alias("transaction"),
        F.when(line == 3, "soon").otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
        F.when(line != 2, F.col("blockNumber").cast("string")).alias("blockNumber"),
        token("token0").alias("token0"),
        token("token1").alias("token1"),
        "amount0",
        "amount1",
        "sqrtPriceX96",
    )
    good = F.to_json(F.struct(F.struct(F.array(swap).alias("swaps")).alias("data")))
    bad = F.to_json(F.struct(F.array(F.struct(F.lit("indexing").alias("message"))).alias("errors")))
    return A.swaps(spark, d).select(F.when(line == 5, bad).otherwise(good).alias("value"))


@query(
    "swap_pages_parsed",
    f"""WITH {S.SWAPS}
    SELECT concat('tx-', id) AS txHash, blockNumber, timestamp,
           token0, token1, amount0, amount1, sqrtPriceX96
    FROM swaps WHERE line NOT IN (2, 3, 5)""",
)
def swap_pages_parsed(spark, d):
    return swaps.parse_swap_pages(_pages(spark, d))[0].select(*SWAP_COLUMNS)


@query(
    "swap_pages_rejected",
    """SELECT CASE l_linenumber WHEN 5 THEN 'errors: indexing' WHEN 3 THEN 'bad timestamp' ELSE 'bad blockNumber' END AS reason,
              count(*) AS rows
       FROM lineitem WHERE l_linenumber IN (2, 3, 5) GROUP BY 1""",
)
def swap_pages_rejected(spark, d):
    return swaps.parse_swap_pages(_pages(spark, d))[1].groupBy("reason").agg(F.count("*").alias("rows"))


@query(
    "recent_swaps",
    f"WITH {S.SWAP_ROWS} SELECT id, timestamp, amount0, amount1 FROM swap_rows WHERE timestamp >= {NOW - YEAR * 60}",
)
def recent_swaps(spark, d):
    return swaps.recent(A.swap_rows(spark, d).select("id", "timestamp", "amount0", "amount1"), YEAR, NOW)


PAGE_ORDER = ["timestamp", "id", "amount0", "amount1"]


@query(
    "swap_page",
    f"""WITH {S.SWAP_ROWS} SELECT timestamp, id, amount0, amount1 FROM swap_rows
    ORDER BY timestamp, id, amount0, amount1 LIMIT 100 OFFSET 300""",
)
def swap_page(spark, d):
    return swaps.page(A.swap_rows(spark, d).select(*PAGE_ORDER), PAGE_ORDER, 100, 300)


@query(
    "swap_page_after",
    f"""WITH {S.SWAP_ROWS} SELECT timestamp, id, amount0, amount1 FROM swap_rows
    WHERE (timestamp, id, amount0, amount1) > ({NOW}, '5', '', '')
    ORDER BY timestamp, id, amount0, amount1 LIMIT 100""",
)
def swap_page_after(spark, d):
    return swaps.page_after(A.swap_rows(spark, d).select(*PAGE_ORDER), PAGE_ORDER, 100, (NOW, "5", "", ""))


@query(
    "swap_page_after_nulls",
    """WITH rows AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS a, CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey END AS b,
        l_orderkey AS k, l_linenumber AS line FROM lineitem)
    SELECT a, b, k, line FROM rows WHERE a IS NOT NULL OR b IS NOT NULL OR (k, line) > (50, 1)
    ORDER BY a NULLS FIRST, b NULLS FIRST, k, line LIMIT 20000""",
)
def swap_page_after_nulls(spark, d):
    """The page after a row whose first order values are NULL; it reaches from NULLs into values."""
    rows = A.table(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey")).alias("a"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_suppkey")).alias("b"),
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("line"),
    )
    return swaps.page_after(rows, ["a", "b", "k", "line"], 20000, (None, None, 50, 1))


@query("capped_swaps", "SELECT least(count(*), 1234) AS rows FROM lineitem")
def capped_swaps(spark, d):
    return swaps.cap(A.swap_rows(spark, d), 1234).agg(F.count("*").alias("rows"))


ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS o_orderdate,
       o_orderpriority FROM orders"""


def _file_round_trip(spark: SparkSession, d: str, fmt: str) -> DataFrame:
    orders = A.table(spark, d, "orders").withColumn("o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp")))
    path = files.write(orders, run_dir(spark, f"orders-{fmt}"), fmt)
    return files.read(spark, path, fmt, orders.schema)


@query("csv_files", ORDERS_SQL)
def csv_files(spark, d):
    return _file_round_trip(spark, d, "csv")


@query("json_files", ORDERS_SQL)
def json_files(spark, d):
    return _file_round_trip(spark, d, "json")


@query("parquet_files", ORDERS_SQL)
def parquet_files(spark, d):
    return _file_round_trip(spark, d, "parquet")


@query(
    "write_if_changed",
    """SELECT true AS first_written, false AS same_written, false AS reordered_written, true AS changed_written, true AS renamed_written,
              true AS retyped_written, true AS reformatted_written, count(*) AS rows FROM orders""",
)
def write_if_changed(spark, d):
    orders = A.table(spark, d, "orders")
    path = run_dir(spark, "changed")
    first = files.write_if_changed(orders, path, "parquet")
    same = files.write_if_changed(orders.repartition(4), path, "parquet")
    changed = files.write_if_changed(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, "parquet")
    reordered = files.write_if_changed(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1).select(*sorted(orders.columns, reverse=True)), path, "parquet")
    renamed = files.write_if_changed(orders.withColumnRenamed("o_custkey", "customer"), path, "parquet")
    typed = orders.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    retyped = files.write_if_changed(typed, path, "parquet")
    reformatted = files.write_if_changed(typed, path, "json")
    return spark.read.schema(typed.schema).json(path).agg(
        F.lit(first).alias("first_written"),
        F.lit(same).alias("same_written"),
        F.lit(reordered).alias("reordered_written"),
        F.lit(changed).alias("changed_written"),
        F.lit(renamed).alias("renamed_written"),
        F.lit(retyped).alias("retyped_written"),
        F.lit(reformatted).alias("reformatted_written"),
        F.count("*").alias("rows"),
    )


@query(
    "changed_parts",
    """WITH years AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)
       SELECT CAST(count(*) AS BIGINT) AS first_written, CAST(0 AS BIGINT) AS same_written, CAST(1 AS BIGINT) AS changed_written, count(*) - 1 AS changed_kept,
              CAST(sum(n) AS BIGINT) AS rows, (SELECT count(*) FROM orders WHERE year(o_orderdate) = 1996) AS rows_of_year,
              (SELECT sum(o_custkey + CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END)::BIGINT FROM orders) AS key_sum FROM years""",
)
def changed_parts(spark, d):
    """Orders by year, written, written again in another order, and again with one year changed."""
    orders = A.table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    path = run_dir(spark, "parts")
    first = parts.write_changed_parts(orders, path, "year")
    same = parts.write_changed_parts(orders.repartition(4), path, "year")
    changed = parts.write_changed_parts(
        orders.withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("year") == 1996, 1).otherwise(0).cast(orders.schema["o_custkey"].dataType)), path, "year"
    )
    stands = parts.read_parts(spark, path, orders.schema, "year")
    return stands.agg(
        F.lit(first["written"]).cast("bigint").alias("first_written"),
        F.lit(same["written"]).cast("bigint").alias("same_written"),
        F.lit(changed["written"]).cast("bigint").alias("changed_written"),
        F.lit(changed["kept"]).cast("bigint").alias("changed_kept"),
        F.count("*").alias("rows"),
        F.lit(parts.read_parts(spark, path, orders.schema, "year", [1996]).count()).cast("bigint").alias("rows_of_year"),
        F.sum("o_custkey").cast("bigint").alias("key_sum"),
    )


@query(
    "state_log",
    """SELECT max(l_orderkey) AS last_processed_block, count(*) AS rows_after,
              'kept' AS note FROM lineitem""",
)
def state_log(spark, d):
    rows = A.swap_rows(spark, d)
    path = run_dir(spark, "state")
    before = state.load_state(spark, path)["last_processed_block"]
    state.save_state(spark, path, note="kept")
    state.save_state(spark, path, block=state.latest_block(rows).first()[0])
    now = state.load_state(spark, path)
    return rows.agg(
        F.lit(now["last_processed_block"]).cast("bigint").alias("last_processed_block"),
        F.count_if(F.col("blockNumber") >= before).alias("rows_after"),
        F.lit(now["note"]).alias("note"),
    )


BLOCK_COLUMNS = ["id", "blockNumber", "timestamp"]


@query("after_block", f"WITH {S.SWAP_ROWS} SELECT id, blockNumber, timestamp FROM swap_rows WHERE blockNumber > 700")
def after_block(spark, d):
    return swaps.after_block(A.swap_rows(spark, d).select(*BLOCK_COLUMNS), 700)


@query(
    "block_range",
    f"WITH {S.SWAP_ROWS} SELECT id, blockNumber, timestamp FROM swap_rows WHERE blockNumber BETWEEN 100 AND 900",
)
def block_range(spark, d):
    return swaps.block_range(A.swap_rows(spark, d).select(*BLOCK_COLUMNS), 100, 900)


@query(
    "blocks_from_ranges",
    f"WITH {S.SWAP_ROWS} SELECT id, blockNumber, timestamp FROM swap_rows WHERE blockNumber BETWEEN 100 AND 900",
)
def blocks_from_ranges(spark, d):
    """The same from a table laid out by ranges of 250 blocks, after a second run wrote some of them again."""
    rows, path = A.swap_rows(spark, d).select(*BLOCK_COLUMNS), run_dir(spark, "blocks")
    layout.write_by_block(rows, path, 250)
    layout.write_by_block(rows.where("blockNumber BETWEEN 500 AND 999"), path, 250)
    return layout.read_by_block(spark, path, rows.schema, 100, 900, 250)


@query(
    "deep_page",
    """SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, l_suppkey AS supplier, l_extendedprice AS price FROM lineitem
    ORDER BY ALL LIMIT 200 OFFSET (SELECT CAST(0.8 * count(*) AS BIGINT) FROM lineitem)""",
)
def deep_page(spark, d):
    """A page after four fifths of the rows, from the ranges that it lies in."""
    order, path = ["k", "line", "part", "supplier", "price"], run_dir(spark, "ranked")
    rows = A.table(spark, d, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS line", "l_partkey AS part", "l_suppkey AS supplier", "l_extendedprice AS price")
    layout.write_ranked(rows, order, path)
    return layout.page_ranked(spark, path, rows.schema, order, 200, int(0.8 * rows.count()))


@query("latest_block", "SELECT coalesce(max(l_orderkey), 0) AS latest_block FROM lineitem")
def latest_block(spark, d):
    return state.latest_block(A.swap_rows(spark, d))


@query("loaded_prices", "SELECT p_name AS token_id, p_retailprice AS price_usd FROM part")
def loaded_prices(spark, d):
    quote = F.create_map(F.lit("eur"), F.lit(0.5), F.lit("usd"), F.col("p_retailprice"))
    raw = A.table(spark, d, "part").select(F.to_json(F.create_map(F.col("p_name"), quote)).alias("value"))
    return prices.load_prices(raw)


TOKENS_SQL = """tokens AS (
  SELECT DISTINCT token FROM (SELECT token0 AS token FROM swaps UNION ALL SELECT token1 FROM swaps) WHERE token <> '')"""


@query("unique_tokens", f"WITH {S.SWAPS}, {TOKENS_SQL} SELECT token FROM tokens")
def unique_tokens(spark, d):
    return prices.unique_tokens(A.swaps(spark, d))


@query(
    "filled_prices",
    f"""WITH {S.SWAPS}, {TOKENS_SQL}, {S.PRICES}
    SELECT t.token, coalesce(p.price_usd, 0) AS price_usd FROM tokens t LEFT JOIN prices p ON t.token = p.token""",
)
def filled_prices(spark, d):
    return prices.fill_missing_prices(prices.unique_tokens(A.swaps(spark, d)), A.prices(spark, d))


@query(
    "price_on_date",
    """WITH daily AS (
         SELECT o_orderpriority AS token_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS usd
         FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
       SELECT o_orderkey, strftime(o.o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS token_id,
              usd AS price_on_date
       FROM orders o LEFT JOIN daily ON o_orderpriority = token_id AND CAST(o.o_orderdate AS DATE) = daily.date""",
)
def price_on_date(spark, d):
    rows = A.table(spark, d, "orders").withColumns(
        {"token_id": F.col("o_orderpriority"), "date": F.to_date("o_orderdate")}
    )
    daily = rows.where(F.col("o_orderstatus") == "F").groupBy("token_id", "date").agg(F.max("o_totalprice").alias("usd"))
    priced = prices.price_on_date(rows.select("o_orderkey", "token_id", "date"), daily)
    return priced.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "search_tokens",
    """SELECT p_partkey, p_name AS name, p_brand AS symbol FROM part
       WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring')""",
)
def search_tokens(spark, d):
    tokens = A.table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("symbol")
    )
    return prices.search_tokens(tokens, " RING ")


SEARCHES = (" RING ", "b", "#1", "d#2", "no such token", "")


@query(
    "search_index",
    " UNION ALL ".join(
        f"""SELECT '{text}' AS query, p_partkey, p_name AS name, p_brand AS symbol FROM part
       WHERE contains(lower(p_name), '{text.strip().lower()}') OR contains(lower(p_brand), '{text.strip().lower()}')"""
        for text in SEARCHES
    ),
)
def search_index(spark, d):
    """Several searches by the letter index, texts under three letters among them."""
    tokens = A.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"))
    path = run_dir(spark, "letters")
    search.write_token_index(tokens, path)
    found = [search.search_index(spark, path, tokens.schema, text).select(F.lit(text).alias("query"), "*") for text in SEARCHES]
    return reduce(DataFrame.unionByName, found)


@query(
    "token_info",
    """SELECT l_orderkey, l_partkey AS token_id, p_name AS name, p_brand AS symbol, p_size AS size
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def token_info(spark, d):
    rows = A.table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("token_id"))
    info = A.table(spark, d, "part").select(
        F.col("p_partkey").alias("token_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("symbol"),
        F.col("p_size").alias("size"),
    )
    return prices.token_info(rows, info)


IDENTIFIER_SQL = """CASE o_orderkey % 4
  WHEN 0 THEN concat('0xNation_', CAST(o_orderkey % 30 AS VARCHAR))
  WHEN 1 THEN concat(' Nation_', CAST(o_orderkey % 30 AS VARCHAR), ' ')
  WHEN 2 THEN concat('Coin-', CAST(o_orderkey % 30 AS VARCHAR)) ELSE 'NATION_5' END"""


def _identifiers(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    number = (key % 30).cast("string")
    name = (
        F.when(key % 4 == 0, F.concat(F.lit("0xNation_"), number))
        .when(key % 4 == 1, F.concat(F.lit(" Nation_"), number, F.lit(" ")))
        .when(key % 4 == 2, F.concat(F.lit("Coin-"), number))
        .otherwise("NATION_5")
    )
    return A.table(spark, d, "orders").select("o_orderkey", name.alias("token"))


def _id_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    nation = A.table(spark, d, "nation")
    addresses = nation.select(
        F.concat(F.lit("0x"), F.lower("n_name")).alias("key"), F.concat(F.lit("addr-"), "n_nationkey").alias("token_id")
    )
    symbols = nation.select(F.lower("n_name").alias("key"), F.concat(F.lit("sym-"), "n_nationkey").alias("token_id"))
    return addresses, symbols


RESOLVED_SQL = f"""ids AS (
  SELECT concat('0x', lower(n_name)) AS key, concat('addr-', CAST(n_nationkey AS VARCHAR)) AS token_id FROM nation
  UNION ALL SELECT lower(n_name), concat('sym-', CAST(n_nationkey AS VARCHAR)) FROM nation),
named AS (SELECT o_orderkey, {IDENTIFIER_SQL} AS token FROM orders),
resolved AS (SELECT o_orderkey, token, coalesce(ids.token_id, token) AS token_id
             FROM named LEFT JOIN ids ON trim(lower(token)) = key)"""


@query("resolved_tokens", f"WITH {RESOLVED_SQL} SELECT o_orderkey, token, token_id FROM resolved")
def resolved_tokens(spark, d):
    return prices.resolve_token(_identifiers(spark, d), "token", *_id_tables(spark, d))


@query(
    "prices_by_token",
    f"""WITH {RESOLVED_SQL}, by_id AS (
      SELECT concat('sym-', CAST(n_nationkey AS VARCHAR)) AS id, CAST(n_regionkey + 1 AS DOUBLE) AS price FROM nation
      WHERE n_regionkey <> 2)
    SELECT token, coalesce(price, 0) AS price_usd
    FROM (SELECT DISTINCT token, token_id FROM resolved) LEFT JOIN by_id ON token_id = id""",
)
def prices_by_token(spark, d):
    by_id = (
        A.table(spark, d, "nation")
        .where(F.col("n_regionkey") != 2)
        .select(
            F.concat(F.lit("sym-"), "n_nationkey").alias("token_id"),
            (F.col("n_regionkey") + 1).cast("double").alias("price_usd"),
        )
    )
    tokens = _identifiers(spark, d).select("token").distinct()
    return prices.prices_by_token(tokens, by_id, *_id_tables(spark, d))


# Cleaning


def _dirty(spark: SparkSession, d: str) -> DataFrame:
    """Swap rows with text that is no number on line 4 and no block on line 6."""
    line = F.col("line")
    return A.swaps(spark, d).withColumns(
        {
            "amount0": F.when(line == 4, "n/a").otherwise(F.col("amount0")),
            "amount1": F.when(line % 2 == 1, F.substring("amount1", 2, 40)).otherwise(F.col("amount1")),
            "blockNumber": F.when(line != 6, F.col("blockNumber").cast("string")),
            "timestamp": F.col("timestamp").cast("string"),
        }
    )


NORMALIZED_SQL = f"""{S.SWAPS}, normalized AS (
  SELECT id, CASE WHEN line <> 6 THEN blockNumber END AS blockNumber, timestamp,
         CASE WHEN line <> 4 THEN CAST(amount0 AS DOUBLE) END AS amountIn,
         CASE WHEN line % 2 = 1 THEN -CAST(amount1 AS DOUBLE) ELSE CAST(amount1 AS DOUBLE) END AS amountOut,
         token0 AS tokenIn, token1 AS tokenOut, txHash AS transaction,
         strftime(to_timestamp(timestamp) AT TIME ZONE 'UTC', '%Y-%m-%d') AS date
  FROM swaps)"""
NORMALIZED_COLUMNS = "id, blockNumber, timestamp, amountIn, amountOut, tokenIn, tokenOut, transaction, date"


def _shown(df: DataFrame) -> DataFrame:
    shown = df.withColumns({"timestamp": F.unix_timestamp("timestamp"), "date": F.date_format("date", "yyyy-MM-dd")})
    return shown.select(*NORMALIZED_COLUMNS.split(", "))


@query("normalized_swaps", f"WITH {NORMALIZED_SQL} SELECT {NORMALIZED_COLUMNS} FROM normalized")
def normalized_swaps(spark, d):
    return _shown(clean.normalize_swaps(_dirty(spark, d)))


REQUIRED_SQL = "blockNumber IS NOT NULL AND amountIn >= 0"


@query(
    "validated_swaps",
    f"WITH {NORMALIZED_SQL} SELECT {NORMALIZED_COLUMNS} FROM normalized WHERE {REQUIRED_SQL} AND amountOut >= 0",
)
def validated_swaps(spark, d):
    return _shown(clean.validate(clean.normalize_swaps(_dirty(spark, d))))


@query(
    "validated_swaps_negative_out",
    f"WITH {NORMALIZED_SQL} SELECT {NORMALIZED_COLUMNS} FROM normalized WHERE {REQUIRED_SQL}",
)
def validated_swaps_negative_out(spark, d):
    return _shown(clean.validate(clean.normalize_swaps(_dirty(spark, d)), allow_negative=["amountOut"]))


@query(
    "deduped_swaps",
    f"""WITH {S.SWAP_ROWS} SELECT id, blockNumber, timestamp, amount0, amount1, trader FROM swap_rows
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp, amount0, amount1, trader) = 1""",
)
def deduped_swaps(spark, d):
    rows = A.swap_rows(spark, d).select("id", "blockNumber", "timestamp", "amount0", "amount1", "trader")
    return clean.dedupe(rows, "id", ["timestamp", "amount0", "amount1", "trader"])


# Enrichment


@query(
    "price_join",
    f"""WITH {S.SWAPS}, {S.DIMS}, {S.LOOKED_UP}
    SELECT id, token0, token1, amount0, amount1, price0, price1 FROM looked_up
    WHERE price0 IS NOT NULL AND price1 IS NOT NULL""",
)
def price_join(spark, d):
    rows = A.swaps(spark, d).select("id", "token0", "token1", "amount0", "amount1")
    return enrich.price_join(rows, A.prices(spark, d))


@query(
    "price_join_zero",
    f"""WITH {S.SWAPS}, {S.DIMS}, {S.LOOKED_UP}
    SELECT id, token0, token1, amount0, amount1, coalesce(price0, 0) AS price0, coalesce(price1, 0) AS price1
    FROM looked_up""",
)
def price_join_zero(spark, d):
    rows = A.swaps(spark, d).select("id", "token0", "token1", "amount0", "amount1")
    return enrich.price_join(rows, A.prices(spark, d), missing="zero")


@query(
    "skipped_swaps",
    f"""WITH {S.SWAP_ROWS}, raw_swaps AS (
      SELECT r.*, CASE WHEN line % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS token0, n_name AS token1
      FROM swap_rows r JOIN part ON l_partkey = p_partkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
    swaps AS (SELECT * REPLACE (CASE WHEN line = 4 THEN 'n/a' ELSE amount0 END AS amount0) FROM raw_swaps),
    {S.DIMS}, {S.LOOKED_UP}, judged AS (
      SELECT id, token0, token1, amount0, amount1,
             CASE WHEN price0 IS NULL OR price1 IS NULL THEN 'missing_price'
                  WHEN quantity0 IS NULL OR quantity1 IS NULL THEN 'invalid_amount' END AS reason
      FROM looked_up)
    SELECT * FROM judged WHERE reason IS NOT NULL""",
)
def skipped_swaps(spark, d):
    bad = F.when(F.col("line") == 4, "n/a").otherwise(F.col("amount0"))
    rows = A.swaps(spark, d).withColumn("amount0", bad).select("id", "token0", "token1", "amount0", "amount1")
    return enrich.skipped(rows, A.prices(spark, d), A.decimals(spark, d))


@query(
    "normalized_amounts",
    f"""WITH {S.SWAPS}, {S.DIMS}, {S.LOOKED_UP}
    SELECT id, token0, token1, amount0, amount1, quantity0, quantity1 FROM looked_up""",
)
def normalized_amounts(spark, d):
    rows = A.swaps(spark, d).select("id", "token0", "token1", "amount0", "amount1")
    return enrich.with_amounts(rows, A.decimals(spark, d))


@query(
    "usd_volume",
    f"""WITH {S.SWAPS}, {S.DIMS}, {S.LOOKED_UP}
    SELECT id, token0, token1, amount0, {S.VOLUME} AS volume FROM looked_up
    WHERE price0 IS NOT NULL AND price1 IS NOT NULL""",
)
def usd_volume_by_side(spark, d):
    rows = A.swaps(spark, d).select("id", "token0", "token1", "amount0", "amount1")
    priced = enrich.with_amounts(enrich.price_join(rows, A.prices(spark, d)), A.decimals(spark, d))
    stable = enrich.token_dim(A.prices(spark, d), A.decimals(spark, d), A.stables(spark, d)).where("stable")
    for suffix in "01":
        side = stable.select(F.col("token").alias(f"key{suffix}"))
        priced = priced.join(side, F.lower(f"token{suffix}") == F.col(f"key{suffix}"), "left")

    def is_stable(suffix: str) -> Column:
        return F.col(f"key{suffix}").isNotNull()

    volume = usd_volume(
        F.col("quantity0"), F.col("price0"), is_stable("0"), F.col("quantity1"), F.col("price1"), is_stable("1")
    )
    return priced.select("id", "token0", "token1", "amount0", volume.alias("volume"))


@query("enriched_swaps", f"WITH {S.ENRICHED} SELECT * FROM enriched")
def all_enriched_swaps(spark, d):
    return enriched_swaps(spark, d).withColumn("line", F.col("line").cast("int"))


@query(
    "swaps_with_current_prices",
    f"""WITH {S.SWAPS}, id_prices AS (
      SELECT p_brand AS token_id, min(p_retailprice) AS usd, max(p_size) - 25.0::DOUBLE AS usd_24h_change
      FROM part GROUP BY p_brand)
    SELECT id, token0 AS tokenIn, amount0, usd AS current_price_usd, usd_24h_change AS price_change_24h
    FROM swaps LEFT JOIN id_prices ON token0 = token_id""",
)
def swaps_with_current_prices(spark, d):
    rows = A.swaps(spark, d).select("id", F.col("token0").alias("tokenIn"), "amount0")
    return enrich.enrich_with_prices(rows, A.id_prices(spark, d))


@query(
    "run_stats",
    f"""WITH {S.ENRICHED}, seen AS (SELECT * FROM looked_up WHERE blockNumber > 700),
    kept AS (SELECT * FROM enriched WHERE blockNumber > 700),
    tokens AS (SELECT DISTINCT token, priced FROM (
      SELECT token0 AS token, price0 IS NOT NULL AS priced FROM seen
      UNION ALL SELECT token1, price1 IS NOT NULL FROM seen))
    SELECT (SELECT count(*) FROM swaps) AS swaps_fetched, (SELECT count(*) FROM seen) AS swaps_new,
           (SELECT count(*) FROM kept) AS swaps_enriched, (SELECT max(blockNumber) FROM swaps) AS latest_block,
           (SELECT count(*) FROM swaps WHERE blockNumber <= 700) AS swaps_filtered,
           (SELECT count(*) FROM seen) - (SELECT count(*) FROM kept) AS swaps_skipped,
           (SELECT count(DISTINCT pair) FROM kept) AS pairs_summarized,
           (SELECT count(*) FROM tokens) AS unique_tokens,
           (SELECT count(*) FROM tokens WHERE priced) AS prices_fetched,
           (SELECT count(*) FROM tokens WHERE NOT priced) AS prices_missing""",
)
def run_stats(spark, d):
    return enrich.run_stats(A.swaps(spark, d), A.prices(spark, d), 700, A.decimals(spark, d))


# Aggregates

SUMMARY_SQL = f"""{S.ENRICHED}, totals AS (
  SELECT pair, count(*) AS count, CAST(sum(CAST(usdVolume AS DECIMAL(28,6))) AS DOUBLE) AS total
  FROM enriched GROUP BY pair),
summary AS (
  SELECT pair, count, {S.scaled('total', 2)} AS totalUSD, {S.scaled('total / count', 2)} AS avgUSD FROM totals)"""


@query("pair_summary", f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def pair_summary(spark, d):
    return aggregate.summarize(_exact(enriched_swaps(spark, d)))


@query("top_pairs", f"WITH {SUMMARY_SQL} SELECT * FROM summary ORDER BY totalUSD DESC, pair LIMIT 20")
def top_pairs(spark, d):
    return aggregate.summarize(_exact(enriched_swaps(spark, d)), top_n=20)


@query(
    "daily_token_agg",
    """WITH rows AS (
      SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, p_brand AS tokenIn, CAST(l_quantity AS DECIMAL(18,2)) AS i,
             CASE WHEN l_linenumber <> 3 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS iu,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS o
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> 'Brand#9')
    SELECT date, tokenIn, CAST(coalesce(sum(i), 0) AS DOUBLE) AS amountIn_sum,
           CAST(sum(i) AS DOUBLE) / count(i) AS amountIn_mean, count(i) AS amountIn_count,
           CAST(coalesce(sum(iu), 0) AS DOUBLE) AS amountInUSD_sum,
           CASE WHEN count(iu) > 0 THEN CAST(sum(iu) AS DOUBLE) / count(iu) END AS amountInUSD_mean,
           CAST(coalesce(sum(o), 0) AS DOUBLE) AS amountOut_sum,
           CAST(sum(o) AS DOUBLE) / count(o) AS amountOut_mean
    FROM rows GROUP BY date, tokenIn""",
)
def daily_token_agg(spark, d):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    part = A.table(spark, d, "part").select("p_partkey", F.when(F.col("p_brand") != "Brand#9", F.col("p_brand")).alias("tokenIn"))
    rows = A.table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    daily = aggregate.daily_token_agg(
        rows.select(
            F.to_date("l_shipdate").alias("date"),
            "tokenIn",
            F.col("l_quantity").cast("decimal(18,2)").alias("amountIn"),
            F.when(F.col("l_linenumber") != 3, price).alias("amountInUSD"),
            price.alias("amountOut"),
        )
    )
    return daily.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "top_traders",
    f"""WITH {S.ENRICHED}, volumes AS (
      SELECT pair, trader, sum(CAST(usdVolume AS DECIMAL(28,6))) AS volume FROM enriched GROUP BY pair, trader),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY volume DESC, trader) AS place FROM volumes)
    SELECT pair, string_agg(trader, ',' ORDER BY place) AS traders FROM ranked WHERE place <= 3 GROUP BY pair""",
)
def top_traders(spark, d):
    best = aggregate.top_traders(_exact(enriched_swaps(spark, d)), 3)
    return best.select("pair", F.concat_ws(",", "tradersTopN").alias("traders"))


@query(
    "mean_std",
    f"""SELECT {S.scaled('avg(l_extendedprice)', 4)} AS mean, {S.scaled('stddev_samp(l_extendedprice)', 4)} AS std
    FROM lineitem""",
)
def mean_std(spark, d):
    stats = aggregate.mean_std(A.table(spark, d, "lineitem"), "l_extendedprice")
    return stats.select(round_scaled(F.col("mean"), 4).alias("mean"), round_scaled(F.col("std"), 4).alias("std"))


@query(
    "merged_mean_std",
    f"""SELECT {S.scaled('avg(l_extendedprice)', 4)} AS mean, {S.scaled('stddev_samp(l_extendedprice)', 4)} AS std
    FROM lineitem""",
)
def merged_mean_std(spark, d):
    """The same from what seven runs kept, one per line number."""
    rows, path = A.table(spark, d, "lineitem"), run_dir(spark, "moments")
    for line in range(1, 8):
        aggregate.moments(rows.where(F.col("l_linenumber") == line), "l_extendedprice").write.mode("append").parquet(path)
    stats = aggregate.merged_mean_std(spark.read.parquet(path))
    return stats.select(round_scaled(F.col("mean"), 4).alias("mean"), round_scaled(F.col("std"), 4).alias("std"))
