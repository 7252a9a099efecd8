import pytest

from openends import config, defaults
from openends.errors import ContractError
from openends.operators import segments
from openends.sources import responses

COLUMNS = config.required_columns(defaults.THEMES)
SCHEMA = ", ".join(f"`{c}` string" for c in COLUMNS)
ROW = (" R1 ", "AD1\t", " Ac  me ", "TV\n30s", "2", " I  saw a\tdog ", None, "glad", "", "short one")


def raw(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_cleaning(spark):
    row = responses.load_responses(raw(spark, ROW), defaults.THEMES).first()
    assert (row.respondent_id, row.ad_id, row.brand, row.platform) == ("R1", "AD1", "Ac me", "TV 30s")
    assert row.order_shown == 2
    assert row["Memory response - what happened"] == "I saw a dog"
    assert row["Meaning response - what the ad was saying"] == ""
    assert row["Why improvement would help"] == "short one"


def test_missing_column_raises(spark):
    with pytest.raises(ContractError, match="Emotion response"):
        responses.load_responses(
            raw(spark, ROW).drop("Emotion response - feeling and why"), defaults.THEMES
        )


def test_extra_column_is_ignored(spark):
    df = raw(spark, (*ROW, "x"), schema=SCHEMA + ", extra string")
    assert "extra" not in responses.load_responses(df, defaults.THEMES).columns


@pytest.mark.parametrize("text, number", [("2", 2), (" 3 ", 3), ("1.7", 1), ("1e1", 10), ("-1", -1)])
def test_order_numbers(spark, text, number):
    df = raw(spark, (*ROW[:4], text, *ROW[5:]))
    assert responses.load_responses(df, defaults.THEMES).first().order_shown == number


@pytest.mark.parametrize("text", ["first", "", None, "nan", "inf", "1,5", "2d", "9e99"])
def test_bad_order_raises_and_names_respondent(spark, text):
    df = raw(spark, ROW, ("R9", "AD1", "b", "p", text, *ROW[5:]))
    with pytest.raises(ContractError, match="R9"):
        responses.check_order(df)
    with pytest.raises(Exception, match="R9"):
        responses.load_responses(df, defaults.THEMES).collect()


def test_rows_without_key_are_dropped(spark):
    df = raw(spark, ROW, (None, *ROW[1:]), (" ", *ROW[1:]), ("R2", " ", *ROW[2:]))
    assert responses.load_responses(df, defaults.THEMES).count() == 1
    assert responses.blank_key_count(df, defaults.THEMES).first().n_blank_keys == 3


def test_counts_and_repeated_pairs(spark):
    df = responses.load_responses(
        raw(spark, ROW, (*ROW[:5], "other", *ROW[6:]), ("R2", *ROW[1:])), defaults.THEMES
    )
    assert tuple(responses.response_counts(df).first()) == (3, 2, 1)
    assert [tuple(r) for r in responses.repeated_pairs(df).collect()] == [("R1", "AD1", 2)]


def test_row_sequence_does_not_depend_on_partitions(spark):
    df = raw(spark, *[(f"R{i}", *ROW[1:]) for i in range(20)])
    seq = lambda d: {r.respondent_id: r.row_seq for r in responses.load_responses(d, defaults.THEMES).collect()}
    assert seq(df) == seq(df.repartition(7))


def test_append_checks_and_grows(spark, tmp_path):
    path = str(tmp_path / "responses")
    responses.append_responses(raw(spark, ROW), path, defaults.THEMES)
    responses.append_responses(raw(spark, ("R2", *ROW[1:])), path, defaults.THEMES)
    stored = responses.read_table(spark, path)
    assert stored.columns == COLUMNS and stored.count() == 2
    with pytest.raises(ContractError):
        responses.append_responses(raw(spark, ROW).drop("Brand"), path, defaults.THEMES)
    with pytest.raises(ContractError):
        responses.append_responses(
            raw(spark, (*ROW[:4], "x", *ROW[5:])), path, defaults.THEMES
        )
    assert responses.read_table(spark, path).count() == 2


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_formats_give_the_same_responses(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    df = raw(spark, ("R1", "AD1", "b", "p", "2", "plain text", "b", "c", "d", "e"))
    df.write.format(fmt).option("header", True).save(path)
    row = responses.load_responses(responses.read_table(spark, path, fmt), defaults.THEMES).first()
    assert row == responses.load_responses(df, defaults.THEMES).first()


def test_segments_are_one_per_theme_with_unique_ids(spark):
    df = responses.load_responses(
        raw(spark, *[(f"R{i}", *ROW[1:]) for i in range(15)]), defaults.THEMES
    )
    rows = segments.build_segments(df, defaults.THEMES).collect()
    assert len(rows) == 15 * 4
    assert len({r.segment_id for r in rows}) == 60
    assert {r.theme for r in rows} == set(defaults.THEMES)


def test_parts_of_an_answer_are_joined(spark):
    full = ("R1", "A", "b", "p", "1", "m", "n", "e", "more music", "it is fun")
    part = ("R2", "A", "b", "p", "1", "m", "n", "e", "", "it is fun")
    none = ("R3", "A", "b", "p", "1", "m", "n", "e", None, " ")
    df = responses.load_responses(raw(spark, full, part, none), defaults.THEMES)
    long = segments.build_segments(df, defaults.THEMES).filter("theme = 'Optimisation'")
    assert {r.respondent_id: r.text for r in long.collect()} == {
        "R1": "more music || it is fun",
        "R2": "it is fun",
        "R3": "",
    }
    assert {r.segment_id for r in long.collect()} == {
        f"R{i}__A__Optimisation" for i in (1, 2, 3)
    }


def test_unpivot_needs_no_shuffle(spark):
    df = responses.load_responses(raw(spark, ROW), defaults.THEMES)
    plan = segments.build_segments(df, defaults.THEMES)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_a_batch_that_is_appended_again_is_there_once(spark, tmp_path):
    path = str(tmp_path / "responses")
    first = raw(spark, ROW, ("R2", *ROW[1:]))
    for rows in (first, first.repartition(3), raw(spark, ("R3", *ROW[1:])), first):
        responses.append_responses(rows, path, defaults.THEMES)
    stored = responses.load_responses(responses.read_table(spark, path), defaults.THEMES)
    assert sorted(r.respondent_id for r in stored.collect()) == ["R1", "R2", "R3"]


def test_a_named_batch_is_replaced(spark, tmp_path):
    path = str(tmp_path / "responses")
    for name in ("R1", "R2"):
        responses.append_responses(raw(spark, (name, *ROW[1:])), path, defaults.THEMES, batch="monday")
    stored = responses.load_responses(responses.read_table(spark, path), defaults.THEMES)
    assert [r.respondent_id for r in stored.collect()] == ["R2"]


def test_a_table_without_batches_goes_on_without_them(spark, tmp_path):
    path = str(tmp_path / "responses")
    raw(spark, ROW).write.parquet(path)
    responses.append_responses(raw(spark, ("R2", *ROW[1:])), path, defaults.THEMES)
    stored = responses.load_responses(responses.read_table(spark, path), defaults.THEMES)
    assert sorted(r.respondent_id for r in stored.collect()) == ["R1", "R2"]
