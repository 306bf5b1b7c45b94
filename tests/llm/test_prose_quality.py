import pyarrow.parquet as pq
import pytest

from foliospark.llm import prose_quality as Q
from foliospark.llm import quality_training as T
from foliospark.llm.quality_labels import HAND
from foliospark.llm.quality_rules import RULES
from tests.conftest import SMALL

PROSE = "The night operator closes the door in the evening. It is not open on the weekend, and the keys are with the front desk."


@pytest.fixture(scope="module")
def known():
    return Q.languages_of((r["lang"], r["word"]) for r in pq.read_table(f"{SMALL}/common_words.parquet").to_pylist())


def kind(text, known):
    return T.decide(RULES, Q.measure(text, known))


CASES = [
    ("prose", PROSE), ("prose", "# Head\n\n" + PROSE + "\n\n" + PROSE), ("prose", PROSE.lower().replace(".", "").replace(",", "")), ("prose", "Q: Who closes the door in the evening?\nA: The night operator closes the door in the evening."),
    ("prose", "\n".join([PROSE[i : i + 41] for i in range(0, len(PROSE), 41)])),
    ("list", "- the red folder\n- the keys\n- the door log\n- the lamp"), ("list", "1. Pallet\n2. Valve\n3. Boiler, gasket\n4. Stamp"), ("list", "Pallet\nThe travel claim\nValve\nStamp AB-12\nThe front desk\nBoiler"), ("list", "valve, stamp, boiler, gasket, pallet, hinge\nlamp; drawer; folder; meter; badge; key"), ("list", "Beacon / crate AM-3241 ........ 3\nCrate / roster HZ-6560 ........ 5\nBadge / valve LL-280 ........ 7"),
    ("table", "| A | B | C |\n| --- | --- | --- |\n| 1 | 2022-01-02 | x |\n| 2 | 2022-03-04 | y |"), ("table", "a\tb\tc\n12\t13\t14\n22\t23\t24"), ("table", "Name;Size;Date\nvalve;12;2020-01-01\nstamp;13;2021-01-01"), ("table", "Beacon: QG-81 | Drawer: 117 | Archive: 789\nBeacon: NB-54 | Drawer: 996 | Archive: 717"),
    ("junk", "00000000  53 07 70 1c 12 89 b2 9b a0 3e c0 c8 a7 1a 94 44\n00000010  d8 52 67 a0 32 73 42 60 30 db 43 2a da 6b af 2c"), ("junk", "n6rfixfyZ3wEJHdzHb1bTrvBIKbkDj35JNuVJetFZ4PG5Du5TRvazBsrwa7wRpntw9MeSFDnOIbJ\nyubXxwH65psX4+utsGnBlgKrt9lg2BLH1Zu8dYhRZAvXC1SVLEiqn5lZ8Jp/hBAUhFGZiw/ghQhQ"),
    ("junk", "2024-09-08T15:01:33.948 ERROR [w-19] protocol.bind rc=-6 0x0881ae\n2024-08-11T21:21:52.478 WARN [w-46] hinge.bind rc=-1 0x5e70ad"), ("junk", "¤{[¬¤~:@@■¬▓[◊&:^=¬◊.]■▓\\▒>@{.=.}:|;~$[\\!_@=$_}#\n@░+■░|^▒+>?¬}];?+"), ("junk", "if(!{{b_23}}=>%d;<b>{{c_2}}=>%s;<b>{{x_71}}||%x;<b>{{z_23}})%d;{{b_62}})%d;"),
    ("junk", "Home > Search > Help > Top\nNext » Back » Menu » Print\nShare / Close / Start / Home"), ("junk", "pqja xcmixv jey gi bngqedlrm qpd rbxhzt mqyno bumay skbnf bas ibokv lvbpadeas laialybftabl qziwttcrg"), ("junk", ""), ("junk", " \n "),
]


@pytest.mark.parametrize(("want", "text"), CASES)
def test_kinds(known, want, text):
    assert kind(text, known) == want


@pytest.mark.parametrize(("want", "text"), CASES)
def test_annotator(known, want, text):
    assert T.annotate(text, set(known)) == want


def test_held_out_accuracy(known):
    """The rules were induced on another table; here they meet these documents for the first time."""
    texts = pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist()
    assert sum(kind(t, known) == T.annotate(t, set(known)) for t in texts) / len(texts) > 0.99


def test_as_people_read_them(known):
    """Documents labelled by hand, which grew no rule."""
    rows = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"], filters=[("doc_id", "in", list(HAND))]).to_pylist()
    assert len(rows) == len(HAND) > 100 and set(HAND.values()) == {"prose", "list", "table", "junk"}
    assert sum(kind(r["text"], known) == HAND[r["doc_id"]] for r in rows) >= 0.98 * len(rows)


def test_any_number_of_languages_and_exact_pairs():
    many = Q.languages_of([(f"l{i}", w) for i in range(40) for w in ("aa", f"w{i}")])
    row = dict(zip(T.NAMES, Q.measure("w39 w39 aa b c b c\nb c x\nb c x", many)))
    assert row["common_words"] == 3 / 13 and row["repeated_pairs"] == 3 / 13 and row["repeated_lines"] == 5 / 28
    assert len(many["aa"]) == 40


def test_training_rows_are_bounded_and_picked_by_spark(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_DOCUMENTS", 5)
    df = spark.createDataFrame([(i, None if i % 3 == 0 else f"t{i}") for i in range(30)], "doc_id long, text string")
    got = T.picked(df, {1, 2})
    assert len(got) == 5 and not {1, 2} & {i for i, _ in got} and got == T.picked(df.repartition(3), {1, 2})


def test_induction_finds_simple_rules():
    import random

    rng = random.Random(1)
    names = T.NAMES
    rows = []
    for _ in range(400):
        v = [rng.random() for _ in names]
        rows.append((tuple(v), "list" if v[3] > 0.7 else "junk" if v[4] <= 0.2 else "prose"))
    rules = T.irep(rows, 3)
    assert sum(T.decide(rules, r) == k for r, k in rows) / len(rows) > 0.95


def test_case_expression(spark):
    rules = [("list", [("marked", ">", 0.5)]), ("table", [("prose", "<=", 0.25), ("digit_ratio", ">", 0.1)])]
    df = spark.createDataFrame([(1.0, 0.6, 0.0, 0.0), (1.0, 0.5, 0.25, 0.2), (1.0, 0.1, 0.9, 0.9), (0.0, 0.9, 0.0, 0.0)], "words double, marked double, prose double, digit_ratio double")
    assert [r[0] for r in df.selectExpr(Q.case_expression(rules)).collect()] == ["list", "table", "prose", "junk"]


def test_frame(spark):
    common = spark.read.parquet(f"{SMALL}/common_words.parquet")
    df = spark.createDataFrame([(1, PROSE, 0), (2, None, 0), (3, "x" * 400_000, 0), (4, PROSE, 0), (5, "".join(f"- item {i}{chr(97 + i % 26)}\n" for i in range(20_000)), 0), (6, "home key\n" * 900, 0)], "doc_id long, text string, words int")
    got = {r["doc_id"]: r["kind"] for r in Q.measured(df, common).select("doc_id", Q.kind_of().alias("kind")).collect()}
    assert got == {1: "prose", 2: "junk", 3: "junk", 4: "prose", 5: "list", 6: "junk"}
