import json

from pyspark.sql import types as T

from cardlake import schemas


def test_avro_record():
    record = schemas.avro_record("Transaction", schemas.TRANSACTION)
    by_name = {f["name"]: f for f in record["fields"]}
    assert (record["type"], record["namespace"], record["name"], len(record["fields"])) == \
        ("record", "com.example", "Transaction", 16)
    assert by_name["idx"] == {"name": "idx", "type": "int"}
    assert by_name["merchant_name"] == {"name": "merchant_name", "type": ["null", "long"], "default": None}
    assert by_name["zip"]["type"] == ["null", "double"]
    json.dumps(record)
    optional = {n: [f.name for f in s.fields if f.nullable] for n, s in schemas.RECORDS.items()}
    assert optional == {"User": ["apartment"], "Card": [], "Transaction": [
        "use_chip", "merchant_name", "merchant_city", "merchant_state", "zip", "errors"]}


def test_enforce(spark):
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.TRANSACTION.fields if f.name != "errors"])
    good = ("1", "u", "c", "2020", "1", "2", "8:41", "$1", None, "4711000123456789012", None, None, "62701.0", "7", "No")
    lost = good[:13] + (None,) + good[14:]
    odd = good[:3] + ("x",) + good[4:9] + ("1.5e", None, None) + good[12:]
    out = schemas.enforce(spark.createDataFrame([good, lost, odd], text), schemas.TRANSACTION)
    valid = out.valid.collect()
    assert len(valid) == 1 and valid[0]["merchant_name"] == 4711000123456789012 and valid[0]["errors"] is None
    assert [f.dataType for f in out.valid.schema.fields] == [f.dataType for f in schemas.TRANSACTION.fields]
    assert sorted(tuple(r["reasons"]) for r in out.rejects.collect()) == [
        ("mcc: null",), ("year: not int", "merchant_name: not bigint")]
