"""Raw documents, notifications and samples at their edges."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import events as E
from tidemark.sources import landing as L
from tidemark.streaming import landing as ST

SOL = "So11111111111111111111111111111111111111112"


def transfer(mint, amount, sender="U"):
    return f'{{"mint":"{mint}","tokenAmount":{amount},"fromUserAccount":"{sender}"}}'


def swap(transfers, source="RAYDIUM", kind="SWAP", at=1):
    return f'{{"type":"{kind}","source":"{source}","timestamp":{at},"tokenTransfers":[{",".join(transfers)}]}}'


def payloads(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "message_id string, payload string")


def test_payload_shapes(spark):
    df = payloads(
        spark, f"[{swap([transfer(SOL, 11), transfer('xpump', 5)])}]", swap([transfer("a", 1), transfer("b", 2), transfer(SOL, 10)]),
        swap([transfer("a", 1)]), "{", None, "[]", "{}", f"[{swap([], kind='TRANSFER')},{swap([transfer('c', 1), transfer(SOL, 10.01)])}]",
    )
    quality = E.payload_quality(df).first()
    assert (quality.sample_size, quality.valid_records, quality.missing_payload, quality.parse_errors, quality.empty_transactions) == (8, 4, 1, 1, 2)
    pairs = {(r.message_id, r.from_token, r.to_token) for r in E.swap_pairs(df).collect()}
    assert pairs >= {("0", SOL, "xpump"), ("1", "a", SOL), ("2", None, None), ("7", "c", SOL)}
    patterns = E.swap_patterns(E.swap_pairs(df).filter("message_id in ('0','1','2','7')")).first()
    assert (patterns.total_swaps, patterns.sol_pairs, patterns.memecoin_activity, patterns.large_swaps) == (4, 3, 1, 2)


def test_meme_alerts(spark):
    texts = [swap([transfer("xpump", 1), transfer("q", 2)], at=i) for i in range(12)] + [swap([transfer("m", 1), transfer(SOL, 2)], source="PUMP_FUN", at=99)]
    found = {r.mint: r for r in E.meme_trends(payloads(spark, *texts)).collect()}
    assert found["xpump"].alert_level == "HIGH" and found["xpump"].recent_swap_times == [11, 10, 9, 8, 7]
    assert found["m"].alert_level is None and found[SOL].volume_sol == 2.0 and "q" not in found


def test_systematic_sample(spark):
    df = spark.range(103).select("id")
    got = sorted(r["id"] for r in E.systematic_sample(df, ["id"], 10).collect())
    assert got == list(range(0, 100, 10))
    assert E.systematic_sample(df, ["id"], 500).count() == 103


def test_token_list(spark):
    texts = [
        '{"data":{"items":[{"address":"a","symbol":"A","mc":5,"logoURI":"u","price":1.5},{"address":"b","market_cap":7,"mc":1}]}}',
        '{"data":{"tokens":[{"token_address":"c","holder":3}]}}', '{"success":false}', "broken",
    ]
    rows = {r.token_address: r for r in L.token_rows(spark.createDataFrame([(t,) for t in texts], "body string")).collect()}
    assert rows.keys() == {"a", "b", "c"}
    assert (rows["a"].market_cap, rows["a"].logo_uri, rows["a"].price) == (5.0, "u", 1.5)
    assert rows["b"].market_cap == 7.0 and rows["c"].holder == 3


def test_trade_list(spark):
    docs = [
        ("w", '{"data":[{"tx_hash":"h1","owner":"w","block_unix_time":0,"base":{"symbol":"S","ui_change_amount":1.5}}]}'),
        ("w", '{"data":{"trades":[{"tx_hash":"h2","owner":"w"},{"tx_hash":"","owner":"w"},{"owner":"w"},{"tx_hash":"h3","owner":"x"}]}}'),
    ]
    df = spark.createDataFrame(docs, "wallet_address string, body string")
    rows = {r.transaction_hash: r for r in L.trade_rows(df, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).collect()}
    assert rows.keys() == {"h1", "h2"}
    assert rows["h1"].timestamp == datetime(1970, 1, 1) and rows["h1"].base_ui_change_amount == 1.5
    assert rows["h2"].timestamp == datetime(2024, 1, 1) and rows["h2"].base_symbol is None


def test_broker_records(spark):
    body = '{"message_id":"m1","timestamp":"2024-01-01T00:00:00","source_ip":"1.2.3.4","payload":"{}"}'
    records = spark.createDataFrame(
        [(b"k", body.encode(), "topic", 0, 5, datetime(2024, 3, 4, 5, 6)), (None, b"oops", "topic", 0, 6, datetime(2024, 3, 4, 5, 6))],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    rows = {r.offset: r for r in ST.parse_messages(records).collect()}
    assert (rows[5].message_id, rows[5].message_key, rows[5].processing_hour) == ("m1", "k", "05")
    assert rows[6].message_id is None and rows[6].processing_date == "2024-03-04"


def test_streams_equal_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    data = [(i % 7, datetime(2024, 1, 1, i % 24), float(i)) for i in range(100)]
    df = spark.createDataFrame(data, "k int, t timestamp, v double")
    df.repartition(3).write.parquet(source)
    stream = ST.file_source(spark, source, df.schema, max_files=1)
    ST.run_to_end(ST.once_per_key(stream, ["k"], "t"), out, state)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == list(range(7))
    landed = str(tmp_path / "landed")
    query = ST.land(ST.with_partitions(stream, F.col("t")), landed, str(tmp_path / "state2"), every=None)
    query.awaitTermination()
    assert spark.read.parquet(landed).count() == 100
    again = ST.land(ST.with_partitions(stream, F.col("t")), landed, str(tmp_path / "state2"), every=None)
    again.awaitTermination()
    assert spark.read.parquet(landed).count() == 100  # a restart adds nothing
