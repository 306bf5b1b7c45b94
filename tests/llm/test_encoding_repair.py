import random

import pytest

from foliospark.llm import encoding_repair as E

CLEAN = "Die Prüfstelle schließt das Türprotokoll über Öffnungszeiten. Le café résumé à l’entrée d’été dès Noël. Zespół zgłoszeń wyłączył żółtą część. Отдел качества закрывает журнал ключей по просьбе."


def chains():
    yield "utf8 as cp1252", lambda t: E._read(t.encode(), "cp1252", "control")
    yield "utf8 as latin-1", lambda t: t.encode().decode("latin-1")
    yield "utf8 as cp1251", lambda t: E._read(t.encode(), "cp1251", "replace")
    yield "utf8 as mac", lambda t: t.encode().decode("mac_roman")
    yield "twice", lambda t: E._read(E._read(t.encode(), "cp1252", "control").encode(), "cp1252", "control")
    yield "twice latin-1", lambda t: t.encode().decode("latin-1").encode().decode("latin-1")
    yield "cp1251 as cp1252", lambda t: t.encode("cp1251", "ignore").decode("cp1252", "replace")
    yield "escaped", lambda t: t.encode().decode("latin-1").encode("ascii", "xmlcharrefreplace").decode()


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "fragment_id long, text string, word string, original string")


@pytest.mark.parametrize(("name", "garble"), list(chains()))
def test_round_trip(spark, name, garble):
    clean = [CLEAN] * 8 + ["plain ascii", None, ""]
    bad = garble("Отдел качества закрывает журнал ключей по просьбе." if name == "cp1251 as cp1252" else CLEAN)
    df = frame(spark, [*clean, bad, bad])
    found = {r["fragment_id"] for r in E.garbled_words(df).select("fragment_id").distinct().collect()}
    assert found == {11, 12}
    back = {r["fragment_id"]: r["text"] for r in E.restored(df).collect()}
    want = "Отдел качества закрывает журнал ключей по просьбе." if name == "cp1251 as cp1252" else CLEAN
    if name in ("utf8 as cp1251", "cp1251 as cp1252"):
        want_words, got = want.split(), back[11].split()
        assert sum(a == b for a, b in zip(got, want_words)) >= len(want_words) - 3  # a byte that the table lacks is lost for good; a sound word of two letters is let be
    else:
        assert back == {11: want, 12: want}


def test_lost_characters_are_found_and_stay(spark):
    lost = "résumé Отдел".encode("cp1251", "ignore").decode("utf-8", "replace")
    df = frame(spark, ["résumé Отдел качества"] * 5 + [lost])
    assert {r["fragment_id"] for r in E.garbled_words(df).collect()} == {5}
    assert "�" in E.restored(df).first()["text"]


def test_rare_letters_are_sound(spark):
    sound = ["Île-de-Vârn: £12 / €15", "GÂTEAU ROYAL naïve ¿qué? ¡ya!", "ÐURHOLT: †‡ • …", "SÃO VELMO µm ± ½", "Åsbro–Ñandú", "caf&#233; &#8364;40", "Ÿsel-Œuvre «Á» «B»", "А Б В на и с к"]
    df = frame(spark, sound * 2 + [CLEAN] * 4)
    assert E.garbled_words(df).count() == 0


def test_runs_restore_words_the_corpus_lacks(spark):
    df = frame(spark, ["café é à"] * 4 + ["xylÃ©phone"])
    assert [r["text"] for r in E.restored(df).collect()] == ["xyléphone"]


def test_a_clean_frequent_word_beats_its_garbled_twin(spark):
    df = frame(spark, ["второй план"] * 6 + ["âòîðîé ïëàí"])
    assert {(r["fragment_id"], r["word"], r["original"]) for r in E.garbled_words(df).collect()} >= {(6, "âòîðîé", "второй")}
    assert all(r["fragment_id"] == 6 for r in E.garbled_words(df).collect())


def test_words_of_like_a_plain_split():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("abé ßЖ\n\t.,’ \x85�") for _ in range(40))
        got = E.words_of(text.encode())
        for c in "\n\t.,":
            text = text.replace(c, " ")
        whole = {w for w in text.split(" ") if not w.isascii()}
        assert whole <= got and all(any(x in w for w in whole) for x in got)


def test_long_text():
    assert E.words_of(("é" * 200_000 + " a" * 200_000).encode()) == {"é" * 200_000}


def test_garbled_words_commoner_than_clean_ones(spark):
    """An export through the wrong encoding that is most of a language: the clean word is not taken for the garbled one."""
    clean = "ł zgłoszeń żółtą"
    df = frame(spark, [E._read(clean.encode(), "cp1252", "control")] * 9 + [clean])
    assert {r["fragment_id"] for r in E.garbled_words(df).collect()} == set(range(9))
    assert {r["text"] for r in E.restored(df).collect()} == {clean}


def test_more_than_once_through_other_tables(spark):
    """Twice through any pair of tables, three times, and with the word garbled once in the corpus too."""
    clean = "Прüfstelle żółtą качества"
    chains = (("cp1251", "cp1251"), ("mac_roman", "cp437"), ("koi8_r", "cp866"), ("cp1250", "cp1252"), ("cp1251", "cp1251", "cp1251"), ("latin-1", "cp850", "cp1252"), ("cp1251",))
    bad = []
    for chain in chains:
        t = clean
        for x in chain:
            t = E._read(t.encode(), x, "control")
        bad.append(t)
    df = frame(spark, [clean] * 4 + bad).cache()
    assert {r["fragment_id"] for r in E.garbled_words(df).collect()} == set(range(4, 4 + len(bad)))
    whole = {"Прüfstelle", "żółtą", "качества"}
    for r in E.restored(df).collect():
        assert set(r["text"].split()) == whole


def test_undone():
    for chain in (("latin-1",) * 4, ("cp1251", "mac_roman", "cp866", "cp1252")):
        t = "żółtą"
        for x in chain:
            t = E._read(t.encode(), x, "control")
        assert "żółtą" in E.undone(t)
    assert E.undone("żółtą") == set()
