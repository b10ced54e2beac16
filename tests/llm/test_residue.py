from hypothesis import given, settings, strategies as st

from assayflow.llm import residue as rs

SCHEMA = "doc_id bigint, text string, class string, reason string"
LONG = "The composite retained its peroxidase-like behaviour in acetate buffer. Particles of about 26 nm were seen in the micrographs. "
BAD = [
    "Please enable JavaScript to view this article.",
    "404 Not Found\n\nThe requested article page could not be found on this server.",
    "Skip to content\n请启用JavaScript后继续浏览全文。\n\nAnnals of Catalysis",
    LONG + "The detection of {{ substrate }} worked.",
    LONG + "The detection of [insert SUBSTRATE here] at pH <<ph>>.",
    "Introduction\n\nVitae lorem porta sed ipsum metus. Magna lorem dolor.",
    LONG + "The value at [ph] was read.",
    "Traceback (most recent call last):\n  File \"render.py\", line 12, in build\nKeyError: 'abstract'",
    "Sample text. Sample text. Sample text.",
]
GOOD = [
    None,
    "",
    " \n",
    LONG,
    LONG + "The plotting page needs JavaScript, while the raw tables can be read without it.",
    LONG + "The core is written as ${{\\rm Fe}_3{\\rm O}_4}$ and the constant as ${K_m}$ below.",
    LONG + "The sets {A} and {B} and [OPD] in [2:1] hold 5% w/v of {111} facets.",
    LONG + "The first download of the spectra ended with error 404, so the files were requested by post.",
    LONG * 400,
]


def _found(spark, texts):
    df = spark.createDataFrame([(i, t, "c", "r") for i, t in enumerate(texts)], SCHEMA)
    return df, {r.doc_id for r in rs.residue_docs(df).collect()}


def test_residue_and_look_alikes(spark):
    df, got = _found(spark, BAD + GOOD)
    assert got == set(range(len(BAD)))
    kept = rs.without_residue(df)
    assert kept.columns == df.columns and kept.count() == len(GOOD)


def test_label_spreads_to_near_duplicates(spark):
    words = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    seed = f"Please enable JavaScript to view this article. {words}"
    texts = {"a": seed, "b": seed + " extra", "c": seed + " extra more", "d": LONG}
    hashes = {k: rs.shingles(t) for k, t in texts.items()}
    reps = spark.createDataFrame([(k, rs.simhash(h), len(h), rs.prefix(h).tolist()) for k, h in hashes.items()], "class string, hash bigint, n_shingles int, prefix array<bigint>")
    got = {r["class"] for r in rs.propagate(reps, spark.createDataFrame(list(texts.items()), "class string, text string"), reps.where("class = 'a'")).collect()}
    assert got == {"a", "b", "c"}


def test_repeated_rows_and_empty_table(spark):
    _, got = _found(spark, [BAD[0]] * 3)
    assert got == {0, 1, 2}
    assert rs.residue_docs(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**63 - 1), min_size=1, max_size=60), st.data())
def test_similar_sets_share_a_least_shingle(a, data):
    a = sorted(a)
    gone = data.draw(st.integers(0, len(a) // 5))
    more = data.draw(st.sets(st.integers(0, 2**63 - 1), max_size=len(a) // 5))
    b = sorted(set(a[gone:]) | more)
    if b and len(set(a) & set(b)) >= rs.MIN_SIMILARITY * len(set(a) | set(b)):
        assert set(rs.prefix(a).tolist()) & set(rs.prefix(b).tolist())
