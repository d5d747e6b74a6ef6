import pytest
from conftest import rows

from lodestrata.contracts import (
    BATCH_ENTITIES,
    ContractError,
    conform,
    conform_present,
    partition_columns,
    schema_for,
    stored_schema,
    struct_of,
    unparsable,
)


def test_every_batch_entity_is_declared_in_all_layers():
    for entity in BATCH_ENTITIES:
        for layer in ("bronze", "silver", "gold"):
            assert schema_for(entity, layer).fieldNames()


def test_types_and_nullability():
    schema = schema_for("meta_municipio", "silver")
    kinds = {f.name: (f.dataType.simpleString(), f.nullable) for f in schema.fields}
    assert kinds["ano"] == ("int", False)
    assert kinds["id_municipio"] == ("string", False)
    assert kinds["meta_alfabetizacao_2030"] == ("double", True)
    assert kinds["atingiu_meta"] == ("boolean", True)
    assert kinds["_silver_processed_at"] == ("timestamp", False)
    assert schema_for("indicador_municipio", "gold")["total_alunos_avaliados"].dataType.simpleString() == "bigint"


def test_gold_contract_sizes():
    views = ("indicador_municipio", "meta_vs_resultado", "evolucao_temporal")
    assert [len(schema_for(v, "gold", lineage=False)) for v in views] == [14, 13, 13]


def test_a_misspelt_type_is_an_error():
    with pytest.raises(ContractError):
        struct_of("ano INTT")


def test_unreadable_text_becomes_null_and_is_told(spark):
    schema = struct_of("ano INT, taxa DOUBLE")
    df = spark.createDataFrame([("2024", "n/d"), ("x", None), ("2023", "1.5")], "ano string, taxa string")
    assert rows(conform(df, schema)) == [(2023, 1.5), (2024, None), (None, None)]
    assert rows(df.select(unparsable(df, schema))) == [("unparsable: ano",), ("unparsable: taxa",), (None,)]


@pytest.mark.parametrize("entity,layer", [("nothing", "silver"), ("uf", "platinum"), ("evolucao_temporal", "bronze")])
def test_unknown_contract(entity, layer):
    with pytest.raises(KeyError):
        schema_for(entity, layer)


def test_partition_layouts():
    assert partition_columns("alunos", "bronze") == ("carga", "ano", "mes", "dia")
    assert partition_columns("municipio", "silver") == ("carga", "ano", "mes", "dia")
    assert partition_columns("alunos", "silver") == ("carga", "mes", "dia")
    assert stored_schema("uf", "silver")["ano"].dataType.simpleString() == "string"
    assert stored_schema("alunos", "bronze")["ano"].dataType.simpleString() == "int"


def test_conform(spark):
    df = spark.createDataFrame([("x", "1", 2)], "regiao string, id_uf string, extra int")
    with pytest.raises(ContractError, match="sigla, nome"):
        conform(df, schema_for("uf", "bronze", lineage=False))
    got = conform_present(df, schema_for("uf", "bronze", lineage=False))
    assert rows(got) == [("1", None, None, "x")]
