from pyspark.sql import functions as F

from holdfast.operators import charts

# Published journey: accounts per cohort and first contact channel.
FIRST = {
    ("Three-Offer Cohort", "Called-In Cancel Flow"): 677,
    ("Three-Offer Cohort", "Called-In first"): 1,
    ("Three-Offer Cohort", "No Action yet"): 17627,
    ("Three-Offer Cohort", "Online Cancel Flow"): 431,
    ("Three-Offer Cohort", "Online first"): 6,
    ("Two-Offer Cohort", "Called-In Cancel Flow"): 403,
    ("Two-Offer Cohort", "No Action yet"): 16194,
    ("Two-Offer Cohort", "Online Cancel Flow"): 357,
    ("Two-Offer Cohort", "Online first"): 4,
}


def test_published_links(spark):
    kinds = spark.createDataFrame(
        [(c, ch, n) for (c, ch), n in FIRST.items()], "cohort string, contact_channel string, n int"
    )
    outcomes = kinds.select(
        "cohort", "contact_channel", F.explode(F.sequence(F.lit(1), "n")).alias("i")
    ).withColumn("billing_account", F.concat_ws("-", "cohort", "contact_channel", "i"))
    links = charts.journey_links(charts.journey_stages(outcomes.drop("i")))
    got = sorted(tuple(r) for r in links.select("source", "target", "value").collect())
    three, two = "Three-Variant Test", "Two-Variant Test"
    call, online, none = "Called-In Cancel Flow", "Online Cancel Flow", "No Action yet"
    assert got == sorted(
        [
            (three, call, 677), (three, call, 1), (three, none, 17627), (three, online, 431),
            (three, online, 6), (two, call, 403), (two, none, 16194), (two, online, 357),
            (two, online, 4), (call, f"Then {online}", 1), (online, f"Then {call}", 10),
        ]
    )
    nodes = charts.journey_nodes(links)
    assert [r["node"] for r in nodes.orderBy("label").collect()] == list(range(7))
    indexed = charts.index_links(links, nodes)
    assert indexed.where("source_idx is null or target_idx is null").isEmpty()
    merged = charts.journey_links(charts.journey_stages(outcomes.drop("i")), aggregate=True)
    assert merged.count() == 8


def test_unmapped_source_and_missing_stage(spark):
    stages = spark.createDataFrame(
        [("x", "y", "a"), ("x", None, "b"), ("y", "y", "c")], "s1 string, s2 string, billing_account string"
    )
    links = charts.journey_links(stages, ["s1", "s2"], {"q": "Q"}).collect()
    assert [tuple(r) for r in links] == [(None, "y", 1)]
