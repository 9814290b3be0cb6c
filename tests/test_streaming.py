from matchlens.streaming import decode_messages, kafka_options, land_messages

SCHEMA = "topic string, key binary, value binary"


def write(spark, folder, rows):
    data = [(t, k.encode(), v.encode()) for t, k, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, target, checkpoint):
    stream = decode_messages(spark.readStream.schema(SCHEMA).parquet(source))
    land_messages(stream, target, checkpoint, once=True).awaitTermination()
    return sorted(r.line for r in spark.read.parquet(target).collect())


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    write(spark, source, [("orders", "k-17", "three pears"), ("orders", "k-ü", "plums")])
    lines = run(spark, source, target, checkpoint)
    batch = decode_messages(spark.read.schema(SCHEMA).parquet(source))
    assert lines == sorted(r.line for r in batch.collect())
    assert lines[0] == "[orders] k-17         -> three pears"

    assert run(spark, source, target, checkpoint) == lines
    write(spark, source, [("orders", "k-99", "")])
    assert len(run(spark, source, target, checkpoint)) == 3
    fresh = run(spark, source, str(tmp_path / "again"), str(tmp_path / "new"))
    assert len(fresh) == 3


def test_offset_policy():
    assert kafka_options("s", "t")["startingOffsets"] == "earliest"
    assert kafka_options("s", "t", extra={"startingOffsets": "latest"})["startingOffsets"] == "latest"
    assert kafka_options("s", "t", True, {"startingOffsets": "latest"})["startingOffsets"] == "earliest"
