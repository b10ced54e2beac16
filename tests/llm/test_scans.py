from assayflow.llm import scans as sc

CLEAN = [
    "The composite retained its peroxidase-like behaviour in acetate buffer.",
    "Modern carbon supports return the cation to its resting state during illumination.",
    "Nano- and microscale aggregates were removed by centrifugation at 12000 rpm for 18 min.",
    "Does Fe2O3 bind H2O2 at once?",
    "Particles of about 26 nm were seen in the micrographs.",
] * 5
CASES = [
    ("The compos!te retained its peroxidase-\nlike beliav-\niour in acetate buffer.", {"misread", "hyphenation"}, "The composite retained its peroxidase-like behaviour in acetate buffer."),
    ("The composite retained its peroxidase-\nlike behaviour in acetate buffer.", set(), "The composite retained its peroxidase-like behaviour in acetate buffer."),
    ("Nano- and microscale aggregates were re- moved by centrifugation at 12O00 rpm for l8 min.", {"misread", "hyphenation"}, "Nano- and microscale aggregates were removed by centrifugation at 12000 rpm for 18 min."),
    ("Modern carbon supports return the cation to 3 its resting state during illumination.", {"furniture"}, "Modern carbon supports return the cation to its resting state during illumination."),
    ("Particles of about 26 nm were seen in the micrographs. Page 2 of 3", {"furniture"}, "Particles of about 26 nm were seen in the micrographs."),
    ("Orvyañex et al. / Journal of Oxide Assays 22 (2012)\nParticles of about 26 nm were seen in the micrographs.", {"furniture"}, "Particles of about 26 nm were seen in the micrographs."),
    ("3    Orvyañex et al. Particles of about 26 nm were seen\n— 4 —\nin the micro¬\ngraphs.", {"furniture", "hyphenation"}, None),
    ("Does Fe203 bind H2O2 at once?", {"misread"}, "Does Fe2O3 bind H2O2 at once?"),
    ("", set(), ""),
    ("  ", set(), "  "),
]


def _rows(spark, texts):
    return spark.createDataFrame([("t", i, t, "x", "y") for i, t in enumerate(texts)], "origin string, row_id bigint, text string, repaired string, damages string")


def test_damage_and_repair(spark):
    rows = _rows(spark, [c[0] for c in CASES] + [None, CASES[0][0]])
    got = {r.row_id: r for r in sc.repaired(rows, _rows(spark, CLEAN)).collect()}
    for i, (_, damages, text) in enumerate(CASES):
        assert set(got[i].damages) == damages, (i, got[i])
        assert text is None or got[i].repaired == text
    assert got[len(CASES)].repaired is None and list(got[len(CASES)].damages) == []
    assert got[len(CASES) + 1].damages == got[0].damages


def test_no_lexicon_long_text_and_empty_tables(spark):
    rows = _rows(spark, ["word " * 20_000 + "\n7\n" + "end", "plain"])
    got = {r.row_id: set(r.damages) for r in sc.repaired(rows, _rows(spark, [])).collect()}
    assert got == {0: {"furniture"}, 1: set()}
    assert sc.repaired(rows.limit(0), _rows(spark, CLEAN)).count() == 0


def test_lexicon_stays_within_its_bound(spark, monkeypatch):
    monkeypatch.setattr(sc, "LEXICON_BOUND", 60)
    lex = sc.build_lexicon(_rows(spark, CLEAN + ["the cation"] * 50))
    assert sum(map(len, lex.values())) <= 60 and lex["w"]["cation"] >= 50


def test_paragraphs():
    lines = ["A first line that runs on and on to the", "end of it.", "A second paragraph with as long a line as", "the first."]
    assert sc.paragraphs(lines) == [lines[:2], lines[2:]]


def test_chains_of_confusions_in_any_word():
    lex = {"w": {"acetate": 9, "illumination": 9, "buffer": 9}, "b": {}, "n": {}}
    d = sc.Decoder(lex)
    assert d.reading("Acctatc") == ("Acetate", 2) and d.reading("il1urnination") == ("illumination", 2)
    slow = sc.Decoder(lex)
    slow.prefixes = None  # without the list of beginnings the same words are found
    assert all(slow.reading(t) == d.reading(t) for t in ("Acctatc", "buttcr", "1llumination", "i11umination", "acetate", "zzz"))


def test_segments_and_joins_over_spaces():
    lex = {"w": {"the": 99, "reaction": 50, "rate": 40, "of": 90, "inhibition": 30, "in": 80, "was": 70, "nanoparticles": 25, "na": 3, "rare": 21}, "b": {}, "n": {}}
    d = sc.Decoder(lex)
    assert d.segments("thereactionrate") == ["the", "reaction", "rate"] and d.segments("reaction") is None and d.segments("thexyz") is None
    assert d.decode("thereactionrate was of in hibition") == (["the reaction rate", "was", "of", "inhibition"], set())
    assert d.decode("the nano parti cles.") == (["the", "nanoparticles."], set())
    assert d.decode("the rare rate of") == (["the", "rare", "rate", "of"], set())
