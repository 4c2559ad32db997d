"""Base detection, column naming and the NULL-token set."""
import pytest

from pyspark.sql import functions as F

from cadastra.sources.dumps import column_plan, has_header, header_names
from cadastra.sources.parquet_io import normalize_names, rename_plan
from cadastra.sources.schema import (CLEAN_BASE_RULES, COLUMNS, INGEST_BASE_RULES, RENAME_BASE_RULES,
                                     detect_base, detect_base_py)


@pytest.mark.parametrize("name,base", [
    ("K3241.K03200Y0.D50712.EMPRECSV", "empresas"), ("Estabelecimentos3.zip", "estabelecimentos"),
    ("F.K03200$W.SIMPLES.CSV.D50712", "simples"), ("F.K03200$Z.D50712.CNAECSV", "cnaes"),
    ("F.K03200$Z.D50712.MUNICCSV", "municipios"), ("F.K03200$Z.D50712.NATJUCSV", "naturezas"),
    ("F.K03200$Z.D50712.MOTICSV", "motivos"), ("K3241.K03200Y0.D50712.SOCIOCSV", "socios"),
    ("F.K03200$Z.D50712.PAISCSV", "paises"), ("F.K03200$Z.D50712.QUALSCSV", "qualificacoes"),
    ("readme.txt", ""),
])
def test_ingest_rules(spark, name, base):
    assert detect_base_py(name, INGEST_BASE_RULES) == base
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(detect_base(df.n, INGEST_BASE_RULES)).first()[0] == base


def test_rule_sets_differ_in_order():
    # 'pais' is checked before 'municipios' when renaming, after it when landing
    assert detect_base_py("municipiospais", RENAME_BASE_RULES) == "paises"
    assert detect_base_py("municipiospais", INGEST_BASE_RULES) == "municipios"
    assert detect_base_py("Socios1.parquet", CLEAN_BASE_RULES) == "socios"
    assert detect_base_py("Cnaes.parquet", CLEAN_BASE_RULES) == ""


def test_column_plan():
    assert column_plan("socios", ["x"] * 11, False) == (COLUMNS["socios"], False)
    assert column_plan("socios", ["x"] * 12, True) == (["x"] + [f"x.{i}" for i in range(1, 12)], True)
    assert column_plan("", ["1", "2", "3"], False) == (["col_00", "col_01", "col_02"], False)
    assert header_names(["a", "", "a", "b c.d"]) == ["a", "Unnamed: 1", "a.1", "b c.d"]


def test_normalize_names():
    assert normalize_names(["Código", "Descrição", "", "Unnamed: 3", "12", "Código"]) == \
        ["codigo", "descricao", "col_02", "col_03", "col_04", "codigo_2"]


def test_rename_plan():
    assert rename_plan("empresas", ["a"] * 7) is None
    assert rename_plan("empresas", ["A B", "c"], include_ees=True) == ["a_b", "c"]
    assert rename_plan("socios", [f"_c{i}" for i in range(11)]) == COLUMNS["socios"]


def test_header_heuristic(spark):
    lines = [("cnpj;razao", True), ('"1";"2"', False), ('"00000000";"JOAO"', True), ("JOAO", False), (None, False)]
    df = spark.createDataFrame(lines, "line string, want boolean")  # any text row with ';' passes, as in the dumps
    assert df.where(has_header(F.col("line")) != F.col("want")).count() == 0


def test_names_fold_like_text_columns(spark):
    from cadastra.functions.text import slug, slug_text
    raw = ["Nº 1ª", "São João", "Straße", "ÆØ å", "½ kg", "e\u0301te\u0301", "Ĳsel", "__a--b__", "ÇÃO²"]
    df = spark.createDataFrame([(x,) for x in raw], "x string")
    assert [r[0] for r in df.select(slug("x")).collect()] == [slug_text(x) for x in raw]
    assert slug_text("Nº 1ª") == "no_1a" and slug_text("½ kg") == "1_2_kg"


def test_null_tokens_are_the_pandas_defaults():
    from pandas._libs.parsers import STR_NA_VALUES
    from cadastra.sources.schema import NA_TOKENS
    assert sorted(NA_TOKENS) == sorted(STR_NA_VALUES)
