"""The SQL of the text operators, on the given tables and on messages that quote."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
import compare
from openends.llm import quotes
from openends.llm.oracle import OP4, ORACLE


@pytest.mark.parametrize("name", ORACLE)
def test_given_tables(spark, sf_dir, name):
    assert spark_entry.oracle_sql()[name] == ORACLE[name]
    assert compare.differences(spark, sf_dir, name) == ""


def test_quoting_messages(spark):
    rows = [
        (1, 0, "a", "Hello there my friend.\n\nHow are you today?\r\nSee you"),
        (1, 1, "b", "> How are you\n> today?\n\nFine, thanks."),
        (1, 2, "a", "On Monday bot wrote:\n> > How are you today?\n> fine,  THANKS.\nGood.\n\n\n\nBye"),
        (1, 5, "b", "> Hello there my friend.\n> See you\nback to this"),
        (1, 6, "a", ">>> no one said that\nand on\n> Good.\n>\n> Bye"),
        (2, 0, None, None), (2, 1, "a", "a > b"), (2, 7, "b", " > a > b\n"), (3, 4, "a", ">"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    got = quotes.reply_order(df)
    columns = sorted(got.columns)
    with duckdb.connect() as connection:
        connection.register("conversations", df.toPandas())
        cursor = connection.execute(f"SELECT {', '.join(columns)} FROM ({OP4})")
        expected = cursor.fetchall()
    plain = lambda found: sorted((tuple(map(str, r)) for r in found))
    assert plain(tuple(r) for r in got.select(columns).collect()) == [
        tuple(x.replace("nan", "None") for x in r) for r in plain(expected)
    ]
