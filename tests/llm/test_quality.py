"""Line rules on small texts; the query is compared with its SQL in test_llm_queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.llm.quality import quality

# Ten sentences without a common run of three words: repeats would fail the base rule.
GOOD = [
    "Rain fell over the quiet harbour while fishermen mended their torn nets.",
    "A baker two streets away opened his shop before anybody else woke up.",
    "Children carried lanterns through narrow lanes and sang about distant mountains.",
    "Nobody expected that letter, yet it arrived with Tuesday's morning post.",
    "Engineers measured every beam twice and found one small crack near its base.",
    "My aunt grows tomatoes, beans and very large sunflowers behind her cottage.",
    "Trains from northern cities were late because snow had covered several signals.",
    "He studied old maps until midnight, hoping to find some forgotten road.",
    "Most birds leave in autumn, but these sparrows stay all winter long.",
    "She finally closed the heavy book, smiled, and switched off the lamp.",
]


def judge(spark, texts):
    df = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id bigint, text string, n_words string")
    rows = quality(df).select("doc_id", "n_words", F.col("quality.*")).orderBy("doc_id").collect()
    return rows


def test_lines_and_documents(spark):
    good = "\n".join(GOOD)
    menu = "Home | News | Sport | Login"
    shout = "BUY! NOW! CHEAP! OFFER!"
    texts = [
        good,
        good + "\n" + menu + "\n" + shout + "\nno end\nAll rights reserved.",
        "\n".join([menu] * 5 + [GOOD[1]]) * 3,
        None,
        "",
        " \t\n\x0b",
        "word " * 100_000,
        good + "\n" + good,
    ]
    rows = judge(spark, texts)
    assert rows[0].asDict()["kept"] and rows[0]["n_lines_removed"] == 0 and rows[0]["clean_text"] == texts[0]
    assert rows[1]["kept"] and rows[1]["clean_text"] == good and rows[1]["n_lines_removed"] == 4
    assert not rows[2]["kept"] and rows[2]["n_dup_lines"] > 0
    for i in (3, 4, 5):
        assert rows[i]["base_failed"] and not rows[i]["kept"] and rows[i]["word_chars"] == 0
    assert rows[6]["n_repeat_words"] == 100_000 and rows[6]["base_failed"]
    assert rows[7]["n_dup_lines"] == 10


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality(df).count() == 0
