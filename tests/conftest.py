import pytest

from swaplens.session import local_session

WETH = "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2"
USDC = "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48"
USDT = "0xdac17f958d2ee523a2206206994597c13d831ec7"
WBTC = "0x2260fac5e5542a773aa44fbcfedf7c193bc2c599"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def swaps(spark):
    rows = [
        ("0x01", 1000, 1640000000, WETH, USDC, "1000000000000000000", "-2000000000", "1"),
        ("0x02", 1001, 1640000100, WETH, USDC, "2000000000000000000", "-4000000000", "1"),
        ("0x03", 1002, 1640000200, WBTC, USDC, "50000000", "-20000000000", "1"),
    ]
    from swaplens.schemas import SWAP_SCHEMA

    return spark.createDataFrame(rows, SWAP_SCHEMA)


@pytest.fixture
def prices(spark):
    return spark.createDataFrame([(WETH, 2000.0), (USDC, 1.0), (WBTC, 40000.0)], "token STRING, price_usd DOUBLE")


@pytest.fixture
def typed_swaps(spark):
    """Two swaps under their trade-side names, everything text."""
    ddl = (
        "id STRING, transaction STRING, timestamp STRING, blockNumber STRING, tokenIn STRING, tokenOut STRING, "
        "amountIn STRING, amountOut STRING, amountInUSD STRING, amountOutUSD STRING"
    )
    rows = [
        ("0x1", "0xa", "1640000000", "1000", "0xt1", "0xt2", "1000000", "2000000", "1000", "2000"),
        ("0x2", "0xb", "1640000100", "1001", "0xt1", "0xt3", "500000", "1500000", "500", "1500"),
    ]
    return spark.createDataFrame(rows, ddl)
