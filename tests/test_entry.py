import __spark_entry__ as e


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


def test_public_names(spark):
    import docframe

    assert docframe.DocFrame.__name__ == "DocFrame" and docframe.Cut("x", [1, 2]).levels == ("(1,2]",)


def test_library_does_not_need_the_training_data_operators():
    import pathlib

    root = pathlib.Path(e.__file__).parent / "docframe"
    assert not [f for f in root.rglob("*.py") if "llm" not in f.parts and "docframe.llm" in f.read_text()]
