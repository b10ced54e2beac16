import pytest

from assayflow.llm import sentences as sn


def _split(text):
    p = [0, *sn.boundaries(text), len(text)]
    return [text[a:b].strip() for a, b in zip(p, p[1:])]


@pytest.mark.parametrize(
    "parts",
    [
        ["Quorunnek et al. reported a constant of 0.037 mM.", "It fell, e.g. at 4 °C.", "The run began at 9 a.m. and stopped."],
        ["This agrees with Myq et al.", "Particles were seen (see Sec. 8.8).", "pH values above 5.0 gave no signal."],
        ['Dr. Y remarked that "the blank stayed. No drift was seen." during the visit.', "“Is it stable? Does it fade?” was asked.", "K. R. Til and T. Sov ran it."],
        ["A referee asked: “Is the signal stable? Does it fade?”", "The solid was dried ... and then weighed again.", "(All spectra were taken.)", "hollow CuO was used."],
        ["Am 3. März wurde Probe Nr. 7 d. h. der Referenz geprüft.", "Dr. X erklärte: „Sie blieb farblos. Es gab keine Drift.“", "Der Fehler betrug ca. 22 %."],
        ["Le Pr. Z a conclu: « Le blanc reste. Rien ne dérive. »", "Plusieurs supports, p. ex. le carbone (cf. tableau 4)."],
        ["¡Ningún color apareció!", "¿Es estable?", "Varios, p. ej. carbón, en la pág. 386."],
        ["В 2021 г. были изучены носители, напр. углерод.", "Размер (ок. 8 нм) на рис. 3."],
        ["The kit holds these parts:", "• acetate buffer, 7 mM, pH 9.3", "• blank without CuO"],
        ["The strain (E. coli, St. X collection) survived 3 min.", "3,3′,5,5′-Tetramethylbenzidine turned blue.", "Use run_4.csv and version 2.9.1 now."],
        ["It exceeded that of Cu-N-C.", "The values of vitamin C fell."],
    ],
)
def test_spaced_scripts(parts):
    assert _split(" ".join(parts).replace(" •", "\n•")) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["为什么CuO在黑暗中仍有活性……目前尚不清楚。", "有评论指出：“空白样品无色。没有漂移。”", "采用水热法（批号No. 5，见Fig. 8）。", "变蓝？", "提高了7倍！"],
        ["査読者は「ブランクは無色である。変動はない。」と述べた。", "Fig. 9に示す。", "安定か？"],
        ["नमूने को रखा गया।", "क्या संकेत स्थिर था?", "MnO2 बना।"],
        ["Ends here.", "The next has no space."],
    ],
)
def test_scripts_without_spaces(parts):
    assert _split("".join(parts)) == parts


def test_offsets_are_code_points_and_edges():
    assert sn.boundaries("𝒳 ok. Next") == [6]
    assert sn.boundaries("A​b c. Next") == [7]
    for t in (None, "", "   ", "One.", "No end", "“Open. Next"):
        assert sn.boundaries(t) in ([], [7])
    assert len(sn.boundaries("Abc def. " * 20_000)) == 19_999


def test_operator(spark):
    df = spark.createDataFrame([(1, "Ab cd. Ef gh.", 0), (1, "Ab cd. Ef gh.", 0), (2, None, 0), (3, "", 0), (4, "One only", 0)], "k int, text string, next_start int")
    from pyspark.sql import functions as F

    got = sorted((r.k, r.next_start) for r in sn.starts(df, F.col("text")).collect())
    assert got == [(1, 7), (1, 7)]
    units = sorted((r.k, r.ord, r.start, r.sentence) for r in sn.units(df, "text", ["k"]).collect())
    assert units == [(1, 0, 0, "Ab cd."), (1, 0, 0, "Ab cd."), (1, 1, 7, "Ef gh."), (1, 1, 7, "Ef gh."), (4, 0, 0, "One only")]
    assert sn.starts(df.limit(0), F.col("text")).count() == 0


def test_many_openers_without_a_closer():
    import time

    t = time.perf_counter()
    assert len(sn.boundaries("( “ [ Abc def. " * 20_000)) == 19_999
    assert len(sn.boundaries("\n x" * 50_000)) == 0
    assert time.perf_counter() - t < 20


def test_letters_whose_lower_case_is_longer():
    assert sn.boundaries("İİİİ et al. were first. Next came İ.") == [24]
