import pytest
from pyspark.sql import types as T

from samplyard.schema import SchemaSpec

TEXT = """
fields:
  id: {type: string, required: true, primary_key: true, system_value: true}
  sample_id: {type: str, required: true, sample_identifier: true, accepted_pattern: "^SMP[0-9]{4}$"}
  config: {type: string, config_identifier: true}
  count: {type: int}
  ratio: {type: Float}
  flag: {type: bool}
  seen: {type: datetime}
  stamp: {type: timestamp}
  day: {type: date, date_format: "%Y/%m/%d", column_mappings: one_source}
  doc: {type: json}
  settings: {type: object}
  amount: {type: decimal}
  place: {type: record, fields: {city: {type: string}, zip: {type: integer}}}
  tags: {type: array, items: {type: string}}
  stops: {type: array, items: {type: record, fields: {n: {type: int}}}}
"""


def test_types_follow_the_declaration():
    struct = SchemaSpec.from_yaml(TEXT).struct
    kinds = {f.name: f.dataType for f in struct}
    assert kinds["count"] == T.LongType()
    assert kinds["ratio"] == T.DoubleType()
    assert kinds["flag"] == T.BooleanType()
    assert kinds["seen"] == T.TimestampNTZType()
    assert kinds["stamp"] == T.TimestampType()
    assert kinds["day"] == T.DateType()
    assert kinds["doc"] == kinds["settings"] == kinds["amount"] == T.StringType()
    assert kinds["place"].fieldNames() == ["city", "zip"]
    assert kinds["tags"] == T.ArrayType(T.StringType())
    assert kinds["stops"].elementType.fieldNames() == ["n"]


def test_attributes_survive_in_the_dataframe_schema(spark):
    schema = SchemaSpec.from_yaml(TEXT)
    df = spark.createDataFrame([], schema.struct)
    back = SchemaSpec.from_struct(df.schema)
    assert back.identifier == "sample_id"
    assert back.config_key == "config"
    assert back.primary_keys == ["id"]
    assert back.required == ["id", "sample_id"]
    assert [f.kind for f in back.fields] == [f.kind for f in schema.fields]
    assert back.patterns == schema.patterns


def test_single_mapping_text_becomes_a_list_and_keeps_the_date_format():
    schema = SchemaSpec.from_yaml(TEXT)
    assert schema.by_name["day"].source_columns == ["one_source"]
    assert schema.date_formats == {"day": "%Y/%m/%d"}


def test_sources_of_the_identifier():
    def sources(extra):
        return SchemaSpec.from_dict({"fields": {"s": {"type": "string", "sample_identifier": True, **extra}}}).identifier_sources

    assert sources({}) == []
    assert sources({"use_field_name": True}) == ["s"]
    assert sources({"column_mappings": ["a", "b"]}) == ["a", "b"]


@pytest.mark.parametrize(
    "body",
    [
        {"type": "string", "accepted_pattern": "("},
        {"type": "string", "date_format": "someday"},
        {"type": "string", "date_format": "%Q"},
        {"type": "array"},
    ],
)
def test_bad_declarations_are_refused(body):
    with pytest.raises(ValueError):
        SchemaSpec.from_dict({"fields": {"x": body}})


def test_unknown_fields_are_named():
    with pytest.raises(ValueError, match="nope"):
        SchemaSpec.from_yaml(TEXT).check_fields(["id", "nope"])
