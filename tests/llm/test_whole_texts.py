"""Whole jobs of the text operators: no bound changes a result."""


def test_p3_same_readings_whatever_the_bound(spark, monkeypatch):
    from assayflow.llm import scans as sc

    df = lambda texts: spark.createDataFrame([("t", i, t) for i, t in enumerate(texts)], "origin string, row_id bigint, text string")
    clean = df(["The rare zirconocene chloride was weighed in air."] * 2 + ["Modern carbon supports return the cation to its resting state."] * 3 + ["the cation"] * 50)
    scanned = df(["The rare zirconocene chloride was weighed in air.", "The rare zircon-\nocene was weighed.", "Modern carbon supports return the cation to 3 its resting state.", "Moclern carbon"])
    read = lambda: {r.row_id: (r.repaired, list(r.damages)) for r in sc.repaired(scanned, clean).collect()}
    want = read()
    assert want[0][1] == [] and want[1] == ("The rare zirconocene was weighed.", ["hyphenation"]) and want[2][1] == ["furniture"] and want[3][1] == ["misread"]
    monkeypatch.setattr(sc, "LEXICON_BOUND", 3)
    assert sum(map(len, sc.build_lexicon(clean).values())) <= 3
    assert read() == want


def test_p3_word_over_many_marks_and_late_variants():
    from assayflow.llm import scans as sc

    lex = {"w": {"electrochemiluminescence": 9, "was": 9, "seen": 9}, "b": {}, "n": {}}
    assert sc.Decoder(lex).decode("elec- tro- che- mi- lu- mi- nes- cen- ce was seen") == (["electrochemiluminescence", "was", "seen"], {"hyphenation"})
    word, damaged = "to" * 50 + "zmzmzm", "to" * 50 + "zrnzrnzrn"  # three confusions after many letters that could be others
    d = sc.Decoder({"w": {word: 9}, "b": {}, "n": {}})
    second = sorted({w for v in d.variants(damaged) for w in d.variants(v)})
    assert len(second) > 4000 and not any(word in d.variants(v) for v in second[:4000])
    assert d.reading(damaged) == (word, 3)


def test_p10_filler_without_the_former_cues():
    from assayflow.llm import residue as rs

    assert rs.trusted("vestigium " * 12)
    for line in ("Sample content.", "Sample copy.", "Это заполнитель: текст-заполнитель.", "NN"):
        assert rs.trusted(line) and (line == "NN" or rs.trusted(f"{line} " * 6))
    assert not rs.trusted("The zeta potential of the particles was 12 mV at pH 7 and fell to 3 mV at pH 4 within ten days.")


def test_p10_chain_of_more_than_fifty_links(spark):
    from assayflow.llm import residue as rs

    words = ["w" + "".join("abcdefghij"[int(c)] for c in str(i)) for i in range(280)]
    docs = spark.createDataFrame([(k, " ".join(words[k * 4 : k * 4 + 60])) for k in range(54)], "doc_id bigint, text string")
    reps = rs.classes(docs)
    texts = reps.join(docs, "doc_id").select("class", "text")
    first = reps.where("doc_id = 0").select("class")
    assert rs.propagate(reps, texts, first).count() == 54
