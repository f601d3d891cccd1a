"""Small tables shared by the tests."""

from jobweave import schemas

USERS = [
    ("ines", "ines@mail.example", "Ines", "Keeps bees and repairs old clocks.", 7, ["board"], "ines@mail.example", True, None, "2024-01-01", None),
    ("tomo", "tomo@mail.example", "Tomo", "Draws maps of rivers and harbours.", 6, ["board"], "tomo@mail.example", True, None, "2024-01-01", None),
    ("vera", "vera@mail.example", "Vera", "Not verified yet, so never matched.", 1, ["board"], None, False, "token-vera", "2024-01-01", None),
]

POSTINGS = [
    ("P-17", "board", "Clock Repairer", "Lütkenhafen", "Permanent", "2025-01-01", "Old clocks want a patient hand.", "https://x.example/P-17", "2024-10-07T09:30:00Z"),
    ("P-40", "board", "River Pilot", "Porto Ninho", "Seasonal", "2024-12-20", "Boats, tides and maps.", "https://x.example/P-40", "2024-10-07T09:30:00Z"),
]


def users(spark, rows=USERS):
    return spark.createDataFrame(rows, schemas.USERS)


def postings(spark, rows=POSTINGS):
    return spark.createDataFrame(rows, schemas.POSTINGS)


def evaluations(spark, rows):
    """Rows of (user_id, job_id, score, email_sent)."""
    full = [(u, j, "board", s, f"About {j}", sent, "2024-10-16T00:00:00") for u, j, s, sent in rows]
    return spark.createDataFrame(full, schemas.EVALUATIONS)


def registry(spark):
    rows = [
        ("board", "Board of Jobs (BoJ)", "BoJ", True, True, "https://x.example", "#0066CC", ["data", "analytics"]),
        ("second", None, None, None, None, None, None, ["economist"]),
        ("third", "Third Board", "Third", False, False, None, "#6B2FA0", []),
    ]
    return spark.createDataFrame(rows, schemas.SOURCES)


def keys(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}
