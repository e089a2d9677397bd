"""Rules on nested values: each reads its array once, with the same verdict."""

from orderloom.functions import casts
from orderloom.plans import release
from orderloom.schemas import CHARGE_ARRAY
from pyspark.sql import functions as F

SOURCE = "a array<struct<n:string,c:string,x:string,y:string>>, id int"


def test_elements_lost_as_cast_lost(spark):
    big = "9" * 12
    rows = [(None, 0), ([], 1), ([("a", "b", "1", "2")], 2), ([("a", "b", "1", "2"), ("a", "b", "1", big)], 3),
            ([("a", "b", "x", "2")], 4), ([("a", "b", None, None)], 5), ([None], 6)]
    df = spark.createDataFrame(rows, SOURCE)
    t = df.schema["a"].dataType
    once = casts.elements_lost("a", t, CHARGE_ARRAY)
    both = casts.cast_lost("a", casts.charges("a"), t, CHARGE_ARRAY)
    got = df.select("id", once.alias("x"), both.alias("y")).collect()
    assert [r.x for r in sorted(got)] == [r.y for r in sorted(got)] == [r in (3, 4) for r in range(7)]
    assert df.select(once)._jdf.queryExecution().optimizedPlan().toString().count("a#") <= 3


def test_price_rule_reads_the_items_once(spark):
    item = "struct<product:struct<price:struct<currentPrice:double,paidPrice:double,listPrice:double,retailPrice:double>>>"
    df = spark.createDataFrame([(((None,),),), (((([],)),),)],
                               f"data struct<releaseEventDetails:struct<releaseItems:array<{item}>>>")
    (_, passes), = release.price_rules()
    assert [r[0] for r in df.select(passes).collect()] == [True, True]
    assert str(passes).count("releaseItems") == 1
