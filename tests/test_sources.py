"""S1-S4 with hand-made edge files."""

import os
import tempfile

from pyspark.sql import types as T

from roomrate.sources import read_delimited, read_inferred, stage, stage_table, write_delimited

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("roomType", T.StringType()),
    T.StructField("price", T.IntegerType()),
    T.StructField("bathrooms", T.DoubleType()),
])


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="roomrate-src-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_repeated_header_dropped_only_on_request(spark):
    p = _write("id,roomType,price,bathrooms\n1,a,10,1\nid,roomType,price,bathrooms\n2,b,20,1.5\n")
    kept = read_delimited(spark, p, SCHEMA)
    dropped = read_delimited(spark, p, SCHEMA, drop_repeated_header=True)
    assert dropped.count() == 2
    # kept: the repeated header is a row whose typed fields did not parse
    rows = sorted(kept.collect(), key=lambda r: (r.id is None, r.id))
    assert len(rows) == 3 and rows[-1].id is None and rows[-1].roomType == "roomType"


def test_quoted_comma_and_bad_rows(spark):
    p = _write('id,roomType,price,bathrooms\n1,"Entire home/apt, top floor",100,1\n'
               "2,short\n3,x,5,1,extra\n4,y,7,2\n")
    good = read_delimited(spark, p, SCHEMA)
    got = {r.id: r for r in good.collect()}
    assert got[1].roomType == "Entire home/apt, top floor" and got[1].price == 100
    assert 4 in got
    assert 2 not in got and 3 not in got
    assert good.count() == 2          # a bare count drops them too
    allrows = read_delimited(spark, p, SCHEMA, keep_corrupt=True).collect()
    assert len(allrows) == 4
    assert sorted(r.id for r in allrows if r._corrupt_record is not None) == [2, 3]


def test_lenient_int_cast(spark):
    p = _write('id,roomType,price,bathrooms\n1,a,,1\n2,a, 7 ,1\n3,a,1.0,1\n4,a,1.9,1\n5,a,$100,1\n')
    got = {r.id: r.price for r in read_delimited(spark, p, SCHEMA).collect()}
    assert got == {1: None, 2: 7, 3: 1, 4: 1, 5: None}


def test_write_read_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 10, 1.5), (2, "b,c", 20, 2.0)], SCHEMA)
    out = os.path.join(tempfile.mkdtemp(prefix="roomrate-out-"), "csv")
    write_delimited(df, out)
    back = read_delimited(spark, out, SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    inferred = read_inferred(spark, out)
    assert set(inferred.columns) == {"id", "roomType", "price", "bathrooms"}
    assert dict(inferred.dtypes)["price"] == "int"


def test_stage_keeps_types_and_partitions(spark):
    df = spark.createDataFrame([(1, "a", 10, 1.5), (2, "b", 20, 2.0), (3, "a", 30, None)], SCHEMA)
    out = os.path.join(tempfile.mkdtemp(prefix="roomrate-stage-"), "t")
    back = stage_table(df, out, partition_by="roomType")
    assert sorted(x for x in os.listdir(out) if x.startswith("roomType=")) == \
        ["roomType=a", "roomType=b"]
    assert dict(back.dtypes) == dict(df.dtypes)
    assert back.filter("roomType = 'a'").count() == 2
    ck = stage(df, "unit")
    assert ck.count() == 3
    root = spark.conf.get("spark.checkpoint.dir").replace("file:", "").rstrip("/")
    assert ck.inputFiles()[0].replace("file://", "").replace("file:", "").startswith(root + "/")


def test_headerless_semicolon_file(spark):
    p = _write("1;a;10;1.5\n2;b;;2\n3;c;x;\n")
    got = {r.id: (r.roomType, r.price, r.bathrooms)
           for r in read_delimited(spark, p, SCHEMA, header=False, sep=";").collect()}
    assert got == {1: ("a", 10, 1.5), 2: ("b", None, 2.0), 3: ("c", None, None)}


def test_empty_last_field_is_not_malformed(spark):
    p = _write("id,roomType,price,bathrooms\n1,a,10,\n2,short\n3,b,,2\n")
    df = read_delimited(spark, p, SCHEMA)
    assert df.count() == 2                       # bare count: no pruning shortcut
    assert sorted(r.id for r in df.select("id").collect()) == [1, 3]
    got = {r.id: (r.price, r.bathrooms) for r in df.collect()}
    assert got == {1: (10, None), 3: (None, 2.0)}
    kept = read_delimited(spark, p, SCHEMA, keep_corrupt=True)
    bad = [r.id for r in kept.select("id", "_corrupt_record").collect()
           if r._corrupt_record is not None]
    assert bad == [2]
