"""Record types of the three streams and the report, and the check of rows against them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

INT, LONG, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_AVRO = {"int": "int", "bigint": "long", "double": "double", "string": "string"}


def required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, False)


def optional(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


# Field names, types and order of the record types.
TRANSACTION = T.StructType([
    required("idx", INT), required("user", STRING), required("card", STRING), required("year", INT),
    required("month", INT), required("day", INT), required("time", STRING), required("amount", STRING),
    optional("use_chip", STRING), optional("merchant_name", LONG), optional("merchant_city", STRING),
    optional("merchant_state", STRING), optional("zip", DOUBLE), required("mcc", INT), optional("errors", STRING),
    required("is_fraud", STRING),
])
USER = T.StructType([
    required("idx", INT), required("user", STRING), required("person", STRING), required("current_age", INT),
    required("retirement_age", INT), required("birth_year", INT), required("birth_month", INT),
    required("gender", STRING), required("address", STRING), optional("apartment", DOUBLE),
    required("city", STRING), required("state", STRING), required("zipcode", INT), required("latitude", DOUBLE),
    required("longitude", DOUBLE), required("per_capita_income__zipcode", STRING),
    required("yearly_income__person", STRING), required("total_debt", STRING), required("fico_score", INT),
    required("num_credit_cards", INT),
])
CARD = T.StructType([
    required("idx", INT), required("user", STRING), required("card_index", LONG), required("card_brand", STRING),
    required("card_type", STRING), required("card_number", LONG), required("expires", STRING), required("cvv", INT),
    required("has_chip", STRING), required("cards_issued", LONG), required("credit_limit", STRING),
    required("acct_open_date", STRING), required("year_pin_last_changed", INT),
    required("card_on_dark_web", STRING),
])
FRAUD_REPORT = T.StructType([
    required("user", STRING), required("count_fraud", LONG), optional("person", STRING),
    optional("current_age", INT), optional("total_debt", STRING), optional("card_number", STRING),
    optional("credit_limit", STRING),
])
REQUEST = T.StructType([
    required("user", STRING), required("card", STRING), required("year", INT), required("month", INT),
    required("day", INT), required("time", STRING), required("amount", STRING), optional("use_chip", STRING),
    optional("merchant_name", LONG), optional("merchant_city", STRING), optional("merchant_state", STRING),
    optional("zip", DOUBLE), required("mcc", INT), optional("errors", STRING), optional("is_fraud", STRING),
])
NAMESPACE = "com.example"
RECORDS = {"Transaction": TRANSACTION, "User": USER, "Card": CARD}


def avro_record(name: str, schema: T.StructType, namespace: str = NAMESPACE) -> dict:
    """The Avro declaration of ``schema``, for ``from_avro`` / ``to_avro`` where that package is deployed."""
    fields = []
    for f in schema.fields:
        kind = _AVRO[f.dataType.simpleString()]
        fields.append({"name": f.name, "type": ["null", kind], "default": None} if f.nullable
                      else {"name": f.name, "type": kind})
    return {"type": "record", "namespace": namespace, "name": name, "fields": fields}


@dataclass(frozen=True)
class Enforced:
    """Rows that fit the schema, and the others with the reasons."""

    valid: DataFrame
    rejects: DataFrame


def enforce(df: DataFrame, schema: T.StructType, fault: Column | None = None) -> Enforced:
    """Cast ``df`` to ``schema`` and split off the rows that do not fit.

    A missing optional column becomes null. A row is rejected when a required field is null (``mcc: null``) or a value
    cannot be cast (``mcc: not int``). Where ``fault`` is not null it is the only reason. Rejected rows keep their values
    as text.
    """
    def source(f: T.StructField) -> Column:
        return F.col(f.name) if f.name in df.columns else F.lit(None).cast(T.StringType())

    def reason(f: T.StructField) -> Column:
        raw, typed = source(f), source(f).try_cast(f.dataType)
        bad = F.when(raw.isNotNull() & typed.isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}"))
        return bad if f.nullable else bad.when(raw.isNull(), F.lit(f"{f.name}: null"))

    def fits(f: T.StructField) -> Column:
        typed = source(f).try_cast(f.dataType).isNotNull()
        return typed | source(f).isNull() if f.nullable else typed

    # Good rows are told by plain comparisons; the texts of the reasons are only made for the others.
    good = F.lit(True) if fault is None else fault.isNull()
    for f in schema.fields:
        good = good & fits(f)
    reasons = F.filter(F.array(*[reason(f) for f in schema.fields]), lambda r: r.isNotNull())
    if fault is not None:
        reasons = F.when(fault.isNotNull(), F.array(fault)).otherwise(reasons)
    valid = df.where(good).select(*[source(f).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    rejects = df.where(~good).select(*[source(f).cast(T.StringType()).alias(f.name) for f in schema.fields],
                                     reasons.alias("reasons"))
    return Enforced(valid, rejects)
