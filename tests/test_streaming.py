"""The stream applies the fitted repair exactly like the batch operator."""

from pyspark.sql import functions as F

from tessera.operators.impute import repair_labels
from tessera.sources.files import scratch_path
from tessera.streaming.label_repair import apply_label_repair, fit_label_repair, repair_file_stream


def _frame(spark):
    rows = [(i, None if i % 10 == 3 else f"B{i % 4}", None if i % 10 == 7 else 1000.0 + (i % 4) * 300 + i % 5)
            for i in range(200)]
    return spark.createDataFrame(rows, "id long, class string, price double")


def test_stream_equals_batch(spark):
    df = _frame(spark)
    state = fit_label_repair(df, "class", "price")
    batch = sorted(map(tuple, repair_labels(df, "class", "price").select("id", "class", "price").collect()))
    inline = sorted(map(tuple, apply_label_repair(df, state, "class", "price").select("id", "class", "price").collect()))
    assert batch == inline

    src = scratch_path(spark, "stream-src")
    df.repartition(3).write.parquet(src)
    out = scratch_path(spark, "stream-out")
    q = repair_file_stream(spark, src, "id long, class string, price double", "class", "price", state,
                           out, scratch_path(spark, "stream-ckpt"))
    q.processAllAvailable()
    q.stop()
    streamed = sorted(map(tuple, spark.read.parquet(out).select("id", "class", F.col("price")).collect()))
    assert streamed == batch


def test_scoring_stream_equals_batch(spark):
    from pyspark.ml.feature import VectorAssembler

    from tessera.operators import models as K
    from tessera.operators import scale as S
    from tessera.streaming.scoring import score_file_stream, score_rows

    rows = [(i, float(i % 10), float(i % 7), "hi" if i % 10 > 4 else "lo", 100.0 + 3 * (i % 10) + (i % 7))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, band string, price double")
    params = S.fit_standard(df, ["price"]).first()
    train = S.apply_standard(df, S.fit_standard(df, ["price"]), ["price"], suffix="_z")
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(train)
    model = K.two_target_model(train, "band", "price_z", regs=(0.001,))
    batch = sorted(map(tuple, score_rows(model, df, "id", ["a", "b"], params["mean_price"],
                                         params["scale_price"]).collect()))
    src = scratch_path(spark, "score-src")
    df.drop("band", "price").repartition(2).write.parquet(src)
    out = scratch_path(spark, "score-out")
    q = score_file_stream(spark, src, "id long, a double, b double", model, "id", ["a", "b"],
                          params["mean_price"], params["scale_price"], out, scratch_path(spark, "score-ckpt"))
    q.processAllAvailable()
    q.stop()
    streamed = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert streamed == batch
    assert {r[1] for r in batch} <= {"hi", "lo"}
