"""Records that cannot be read are kept or raise; none is lost."""

import pytest
from pyspark.sql import functions as F

from carlot.llm import chat_format


def test_unread_records_keep_their_text(spark):
    rows = [(1, '{"prompt": "a"}'), (2, '{"prompt": "a", "id": 3}'), (3, "{broken"), (4, None)]
    records = spark.createDataFrame(rows, "conv_id long, record string")
    found = {r.conv_id: (r.layout, r.record) for r in chat_format.unread_records(records).collect()}
    assert found == {2: ("unknown", rows[1][1]), 3: ("unreadable", "{broken"), 4: ("unreadable", None)}


@pytest.mark.parametrize("size, fails", [(15_000_000, False), (21_000_000, True)])
def test_a_text_too_long_for_the_reader_raises(spark, size, fails):
    said = F.to_json(F.struct(F.repeat(F.lit("x"), F.lit(size)).alias("prompt")))
    records = spark.range(1).select(F.col("id").alias("conv_id"), F.col("id").alias("turn"), said.alias("record"))
    chats = chat_format.format_chat(chat_format.canonical_turns(records)).select(F.length("formatted").alias("n"))
    if fails:
        with pytest.raises(Exception, match="cannot be read"):
            chats.collect()
    else:
        assert chats.first().n > size
