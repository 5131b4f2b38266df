import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlake.llm import encoding as e

TEXTS = [
    "Não há prova de que a eleição do conselho tutelar está ligada a um apagão em São Tirso.", "“A vacina contra a dengue”, diz o órgão, já chegou às escolas; é falso.", "Três câmeras gravam o pedágio: a conta não fecha após a inauguração.",
    "NÃO HÁ PROVA DE QUE A LÂMPADA É ANTIGA", "Últimas notícias: mantém a consulta e publicou páginas sobre a nuvem de gafanhotos.",
]


def lenient(data, encoding):
    return "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in data)


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1251"])
@pytest.mark.parametrize("text", TEXTS)
def test_utf8_read_as_something_else(text, encoding):
    assert e.restore(lenient(text.encode(), encoding)) == ("restored", text)


@pytest.mark.parametrize("text", TEXTS)
def test_two_layers(text):
    once = lenient(text.encode(), "cp1252")
    assert e.restore(lenient(once.encode(), "cp1252")) == ("restored", text)


@pytest.mark.parametrize("encoding", ["cp850", "mac_roman"])
@pytest.mark.parametrize("text", [t for t in TEXTS if not t.isupper()])
def test_single_byte_text_read_as_another(text, encoding):
    assert e.restore(text.encode("cp1252").decode(encoding)) == ("restored", text)


def test_part_of_a_text():
    bad = lenient("A eleição já passou.".encode(), "cp1252")
    assert e.restore(f"Não é a primeira vez. {bad} Até a publicação, nada.") == ("restored", "Não é a primeira vez. A eleição já passou. Até a publicação, nada.")


def test_lost_text():
    assert e.restore("a elei��o j� passou")[0] == "lost"


@pytest.mark.parametrize("text", [None, "", " ", "plain", *TEXTS, "Fran&ccedil;a", "Molière, Ångström e Łódź", "AMANHÔ", "➡️ veja 🔎 ▶ © 2024 · nº 3", "Москва", "слово", "日本語"])
def test_sound_text_stays(text):
    assert e.restore(text) == ("clean", text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("não é a câmera já três pública “ação” ÁUDIO Água órgão – às".split()), max_size=12).map(" ".join))
def test_never_raises_and_sound_text_is_left_alone(text):
    assert e.restore(text)[0] == "clean"
    assert isinstance(e.restore(lenient(text.encode(), "cp1252"))[1], str)


def test_in_spark(spark):
    bad = lenient(TEXTS[0].encode(), "cp1252")
    df = spark.createDataFrame([(1, TEXTS[0], bad, None), (2, "�", None, "x" * 200000 + bad), (None, None, None, None), (1, bad, bad, bad)], "arrival long, title string, summary string, body string")
    got = {(r["key"], r["field"], r["status"]) for r in e.restore_fields(df.withColumnRenamed("summary", "field"), "arrival", ["title", "field", "body"]).collect()}
    assert got == {(1, "field", "restored"), (2, "title", "lost"), (2, "body", "restored"), (1, "title", "restored"), (1, "body", "restored")}
    assert e.found(df).count() == 6 and e.found(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text", ["──────────", "┌──┐ │ab│ └──┘", "È vero che la città è bella", "où il était né", "Più libertà, perché no?", "Der Fußball und die Straße", "│ Total │ 12 │", "─" * 20_000]
)
def test_boxes_and_other_languages_stay(text):
    assert e.restore(text) == ("clean", text)


def test_layers_until_the_cost_stops():
    text = bad = "A ação já é pública"
    for _ in range(6):
        bad = lenient(bad.encode(), "cp1252")
    assert e.restore(bad) == ("restored", text)
