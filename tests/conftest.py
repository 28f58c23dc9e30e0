import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

METRICS = ["frequency", "breadth", "tenure", "tt_cost", "flat"]
SEGMENTS = ["contact_channel_group", "contact_timing", "cohort", "src_risk_tier"]
COLUMNS = ["billing_account", "outcome", *SEGMENTS, "Treatment", *METRICS]

# Segment, Saved accounts, Stopped accounts: unequal, one side empty once, one tier missing.
CELLS = [
    (("phone", "late", "Two-Offer Cohort", None), 9, 14),
    (("web", "late", "Three-Offer Cohort", "2. Medium"), 23, 6),
    (("web", "early", "Two-Offer Cohort", "1. Low"), 5, 0),
    (("phone", "early", "Three-Offer Cohort", "3. High"), 7, 7),
]


def account_rows():
    """Tuples of COLUMNS; values are drawn from a small range, so ties abound."""
    rng = random.Random(31)
    rows = []
    for shift, (segment, saved, stopped) in enumerate(CELLS):
        for outcome, size in (("Saved", saved), ("Stopped", stopped)):
            lift = 4.0 if outcome == "Saved" else -1.0
            for k in range(size):
                treatment = ("Tiered", "Control", "Control", "Midpoint")[k % 4]
                values = (
                    rng.randrange(12) + lift, rng.randrange(4) / 2, float(rng.randrange(30, 400)),
                    None if k == 3 else rng.randrange(9) * 10.0 - 25 * shift, 2.5,
                )
                rows.append((f"{segment[0]}-{shift}-{outcome[:2]}-{k}", outcome, *segment, treatment, *values))
    return rows


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def accounts(spark):
    kinds = ["string"] * 7 + ["double"] * 5
    schema = ", ".join(f"{c} {k}" for c, k in zip(COLUMNS, kinds, strict=True))
    return spark.createDataFrame(account_rows(), schema)
