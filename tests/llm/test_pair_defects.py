from collections import Counter

import pytest

from foliospark.llm import pair_defects as P

COMMON = {"en": "the a of and is to in on".split(), "de": "der die das und ist den im".split(), "fr": "le la les des est et du".split(), "es": "el la los de es y en".split(), "pl": "nie jest na w z do się".split(), "ru": "и в на не что по".split()}
SPOKEN = {
    "en": "What is on the list of the day? The list is on the long desk and the key is in the drawer. Who signs the form during the quiet period, and where does it go? I cannot help with that request.",
    "de": "Wer hat die Liste und den Plan? Der Plan ist im Haus und die Liste ist in der Tasche. Fasse den Abschnitt zusammen. Nenne den Grund, aus dem der Empfang die Schlüssel verwahrt.",
    "fr": "Le plan est dans la maison et les clés du bureau sont sur la table. Résume le passage et décris la liste des clés. Qui a signé le formulaire pendant la période calme?",
    "es": "El plano está en la casa y las llaves de la oficina están en la mesa. Resume el pasaje y describe la lista de las llaves. Quién firmó el formulario durante el período tranquilo?",
    "pl": "Lista jest na stole, a klucze do biura są w szufladzie. Streść fragment i opisz listę kluczy. Kto podpisał formularz w czasie ciszy? Przetłumacz fragment na język rosyjski.",
    "ru": "Список лежит на столе и в ящике. Что лежит на столе? Перескажи отрывок и опиши список ключей. Кто подписал форму во время тихого часа?",
}
WORDS = P.Profiles({k: Counter(t for w in P.words_in(text) for t in P.triples(w)) for k, text in SPOKEN.items()})
ASK = "What is on the list of the day?"


@pytest.mark.parametrize("output", [None, "", " \n", "​", "...", "-", "—", "n/a", "N/A", "null", "None", "[]", '""', "<p></p>", "<br>", "```\n```", "```json\n```", "**", "Answer:", "Output: ", "Antwort: -", "### Response:", "[insert answer here]", "TODO"])
def test_empty(output):
    assert P.judge(ASK, None, output, WORDS)[0] == ["empty"]


@pytest.mark.parametrize("output", ["Yes.", "No", "42", "0.5 %", "None of the items is on the list.", "Answer: it is the first.", "Nothing is left.", "A"])
def test_short_answers_are_answers(output):
    assert "empty" not in P.judge(ASK, None, output, WORDS)[0]


REFUSALS = [
    "I'm sorry, but I can't help with that request.", "As an AI language model, I cannot provide this.", "Unfortunately I must decline to give an answer here.", "I’d rather not reply to that.", "No answer can be given by this assistant.", "This is not something I can answer.", "Hmm. I have to pass on this one.", "Model: I won't be able to assist with this topic.",
    "Dazu möchte ich mich nicht äußern.", "Diese Frage kann ich leider nicht beantworten.", "Hier muss ich passen.", "Eine Antwort ist mir nicht erlaubt.",
    "Je suis désolé, mais je ne peux pas vous aider sur ce point.", "Il m’est impossible de répondre à cette question.", "Je dois passer mon tour.", "Ce sujet m’est interdit.",
    "Lo siento, pero no puedo ayudar con esa petición.", "Prefiero no contestar.", "No me es posible responder a esta pregunta.", "Debo abstenerme.",
    "Przykro mi, ale nie mogę w tym pomóc.", "Wolę nie odpowiadać.", "Nie jestem w stanie odpowiedzieć na to pytanie.", "Muszę odmówić odpowiedzi.",
    "К сожалению, я не могу помочь с этой просьбой.", "Я вынужден отказаться от ответа.", "Мне нельзя об этом говорить.", "Предпочту не отвечать.",
]


@pytest.mark.parametrize("output", REFUSALS)
def test_refusals(output):
    assert P.judge(ASK, None, output, WORDS)[0][:1] == ["refusal"]


@pytest.mark.parametrize(
    ("ask", "output"),
    [
        (ASK, "I’m sorry to say that the pump stopped, but the list is on the desk."), (ASK, "Visitors cannot open the gate; the list is in the office."), (ASK, "The tenant refused the parcel, so the list is on the desk."), (ASK, "The list says: the tool cannot help to open the gate."),
        ("Write a polite sentence declining an offer.", "I am sorry, but I cannot give an answer to the offer."), (ASK, "The list is on the desk. The list is in the hall. I cannot help it."),
    ],
)
def test_no_refusals(ask, output):
    assert "refusal" not in P.judge(ask, None, output, WORDS)[0]


def test_copies():
    text = "The list is long. The day is short."
    long = "The list is long and the day is short, " * 40
    assert "copy" in P.judge("word " * 50 + "x", None, "«" + "Word; " * 50 + "X»", WORDS)[0] and "copy" in P.judge(ASK, long, "Answer:\n" + long.upper(), WORDS)[0]
    assert P.judge(ASK, None, f"{ASK} The list is on the desk.", WORDS)[0] == ["echo"] and P.judge(ASK, text, f"{text} And so it is.", WORDS)[0] == ["echo"]
    assert P.judge(ASK, None, long[:-1] + " but I cannot help with that request.", WORDS)[0][:1] == ["refusal"]
    copied = lambda o, ask=ASK, given=text: "copy" in P.judge(ask, given, o, WORDS)[0]
    assert copied(ASK) and copied(ASK.lower()) and copied(f'"{ASK}"') and copied(f"Question: {ASK}") and copied(f"{ASK} {ASK}") and copied(text) and copied(f"{ASK}\n{text}") and copied(f"{text}\n{ASK}") and copied(f"Instruction: {ASK}")
    assert not copied("The list is long.") and not copied(f"{ASK}\nThe list is long.") and not copied("It is on the desk.")
    assert copied(text, "Copy the first sentence of the passage.") and not copied("The list is long.", "Copy the first sentence of the passage.", "The list is long.")


def test_languages():
    other = lambda ask, o: "language" in P.judge(ask, None, o, WORDS)[0]
    de, ru, fr = "Der Plan ist im Haus und die Liste ist in der Tasche.", "Список лежит на столе и в ящике.", "Le plan est dans la maison et les clés du bureau."
    assert other(ASK, de) and other(ASK, ru) and other(ASK, fr) and other("Wer hat die Liste und den Plan?", ASK + " It is on the desk.") and other("Что лежит на столе?", de)
    assert not other(ASK, "The list is on the desk.") and not other("Translate the passage into German.", de) and not other("Przetłumacz fragment na język rosyjski.", ru) and not other("Wer hat die Liste?", de)
    assert other(ASK, "清单在桌子上，钥匙在抽屉里。") and other(ASK, "Ο κατάλογος είναι στο τραπέζι.") and not other("清单在哪里？", "清单在桌子上。") and not other("どこにありますか？", "机の上にあります。漢字")
    assert not other(ASK, "| Funnel | Nozzle |\n|---|---|\n| ledger | 1 |")
    assert not other("Streść fragment.", "No.") and not other(ASK, "GR-12") and not other("Fasse zusammen.", "42")


def test_certain_breaks():
    cut = lambda o: P.broken_off(o)[0]
    assert cut('Text.\n```\n{"a": 1, "b') and cut("| a | b |\n|---|---|\n| c | 1 |\n| d") and cut("1. One\n2. Two\n3.") and cut("It is on the desk, ") and cut("It is (on the") and cut("See: ")
    assert not cut("```\ncode\n```") and not cut("| a | b |\n|---|---|\n| c | 1 |") and not cut("It is (on the desk).") and not cut("- one\n- two") and not cut("Yes") and not cut("42")


def common_of(spark):
    return spark.createDataFrame([(k, w) for k, ws in COMMON.items() for w in ws] + [(None, "x"), ("en", None)], "lang string, word string")


def test_endings_are_looked_up(spark):
    closed = "The clerk signs the form during the quiet period. The list is on the long desk."
    rows = [(1, ASK, None, closed), (2, ASK, None, "The clerk signs the form during the quiet period"), (3, ASK, None, "The clerk signs the form during the qui"), (4, ASK, None, "- the red list\n- the blue list\n- the key"), (5, ASK, None, "- the key\n- the red list"), (6, ASK, None, "- the key\n- the red li"), (7, "", None, None), (8, None, None, ""), (9, ASK, "x", None), (10, ASK, None, "The list is on the long desk")]
    df = spark.createDataFrame([(*r, "clash") for r in rows] + [(11, *rows[2][1:], "clash")], "record_id long, instruction string, input string, output string, tail string")
    common = common_of(spark)
    got = {r["record_id"]: r["defects"] for r in P.pair_defects(df, common).collect()}
    assert got == {3: ["truncated"], 6: ["truncated"], 9: ["empty"], 11: ["truncated"]}


def test_every_defect_is_shown_in_order(spark):
    rows = [(1, SPOKEN["de"], None, "I'm sorry, I can't help with the list of the day on the desk and the key in the"), (2, ASK, None, "The list " * 100_000 + "of")]
    df = spark.createDataFrame(rows + [(10 + i, SPOKEN[k], None, SPOKEN[k]) for i, k in enumerate([*SPOKEN] * 30)], "record_id long, instruction string, input string, output string")
    got = {r["record_id"]: r["defects"] for r in P.pair_defects(df, common_of(spark)).where("record_id < 10").collect()}
    assert got == {1: ["refusal", "language", "truncated"], 2: ["truncated"]}
