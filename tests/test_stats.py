import random, math, pytest
from pyspark.sql import functions as F
from salescast.operators.stats import global_percentiles
def test_gp(spark):
    rnd=random.Random(5)
    vals=[float(rnd.randint(0,40)) for _ in range(2000)]+[rnd.random()*100 for _ in range(3000)]+[None]*50+[7.0]*3000
    df=spark.createDataFrame([(v,) for v in vals],"v double").repartition(6)
    for ps in ([0,.01,.25,.5,.75,.999,1.0],):
        want=df.agg(*[F.percentile("v",p).alias(f"q{i}") for i,p in enumerate(ps)]).first()
        for acc,most in ((10000,50000),(20,100),(10,10),(5,1)):
            got=global_percentiles(df,[("v",p) for p in ps],acc,most)
            assert got==pytest.approx(list(want)),(acc,most)
    assert global_percentiles(df.where("v is null"),[("v",.5)])==[None]
