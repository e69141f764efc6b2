import time

from cohortkit.functions.text import repair_text

CASES = [
    ("Ãºnico", "único"),
    ("This text is fine already :þ", "This text is fine already :þ"),
    ("This â€” should be an em dash", "This — should be an em dash"),
    ("not such a fan of Charlotte Brontë…”", "not such a fan of Charlotte Brontë…”"),
    ("\xc3\xa0\xc2\xb2\xc2\xa0_\xc3\xa0\xc2\xb2\xc2\xa0", "ಠ_ಠ"),
    ("plain", "plain"), ("", ""), (None, None),
]

WIDE = "Расписание занятий и список заданий для слушателей вечерних курсов математики, физики и химии"


def misread(data: bytes, rounds: int = 1) -> str:
    """Bytes read as Latin-1, and the outcome again so, ``rounds`` times."""
    text = data.decode("latin-1")
    for _ in range(rounds - 1):
        text = text.encode().decode("latin-1")
    return text


def test_imperfect_decodings(spark):
    """A text cut within a character or with a stray byte is read as far as it goes; errors count 100 each."""
    cases = [
        (misread(WIDE.encode()[:-1]), WIDE[:-1] + "\ufffd"), (misread(WIDE.encode() + b" \xff " + WIDE.encode()), WIDE + " \ufffd " + WIDE),
        (misread(WIDE.encode()[:-1], 2), WIDE[:-1] + "\ufffd"),
        ("caf\u00e9 \u00e0 la carte", "caf\u00e9 \u00e0 la carte"),  # plain Latin-1 stays
        ("a " + misread("\u0436".encode() + b"\xff"), "a " + misread("\u0436".encode() + b"\xff")),  # one letter is not worth an error
        ("settled \ufffd \u00c3\u00a9", "settled \ufffd \u00c3\u00a9"),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a string, b string")
    for r in repair_text(df, ["a"]).collect():
        assert r.a == r.b, r.i
    again = repair_text(repair_text(df, ["a"]), ["a"]).collect()
    assert all(r.a == r.b for r in again)


def test_repairs(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(CASES)], "i int, a string, b string")
    for r in repair_text(df, ["a"]).collect():
        assert r.a == r.b


def test_long_plain_runs(spark):
    """Patterns read the odd places of a text, not its long plain runs, which come back as they were."""
    run = "plain words,\n\tand more of them; " * 30_000
    cases = [(run + "Ãºnico" + run, run + "único" + run), ("Ãº" + run + "\xe2\x82\xac\r\n", "ú" + run + "€\r\n"), (run + "é", run + "é")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a string, b string").localCheckpoint()
    repair_text(df.limit(0), ["a"]).collect()
    start = time.monotonic()
    for r in repair_text(df, ["a"]).collect():
        assert r.a == r.b, r.i
    assert time.monotonic() - start < 10
