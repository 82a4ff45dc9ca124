from conftest import lines_df

from cartograph.operators import features as FT
from cartograph.sources import text as TX
from cartograph.streaming import stream_user_aggregates


def test_stream_matches_batch(spark, tmp_out):
    src = f"{tmp_out}/incoming"
    lines_df(spark, ["user_id,a,b,c,d", "1,10,1,pv,100", "2,11,1,buy,150"]).coalesce(1).write.text(f"{src}/day1")
    lines_df(spark, ["1,12,1,cart,300", "3,10,1,fav,50", "bad"]).coalesce(1).write.text(f"{src}/day2")
    q = (stream_user_aggregates(spark, f"{src}/*").writeStream.outputMode("complete")
         .format("memory").queryName("agg_stream")
         .option("checkpointLocation", f"{tmp_out}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(map(tuple, spark.table("agg_stream").collect()))
    batch = FT.user_aggregate(TX.read_behavior_log(spark, [f"{src}/day1", f"{src}/day2"]))
    assert got == sorted(map(tuple, batch.collect()))
    assert dict((r[0], r[2]) for r in got) == {1: 2, 2: 1, 3: 1}
