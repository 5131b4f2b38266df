import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlake.llm import pii as p

CASES = [
    ("Dúvidas: ana_lima11 @ carta.example.net.", [("email", "ana_lima11 @ carta.example.net")]), ("ou por contato+rui [arroba] caixa.example.", [("email", "contato+rui [arroba] caixa.example")]),
    ("e-mail milton.b (at) carta (ponto) example (ponto) net.", [("email", "milton.b (at) carta (ponto) example (ponto) net")]), ("O perfil @checa103 apagou a postagem.", []),
    ("ligue para +55 (57) 9 5380-1466 já", [("phone", "+55 (57) 9 5380-1466")]), ("telefone 00351 951084023.", [("phone", "00351 951084023")]), ("no +351 958 264 423.", [("phone", "+351 958 264 423")]),
    ("número 950-827-738 ou", [("phone", "950-827-738")]), ("Contato: 78999517298 /", [("phone", "78999517298")]), ("para (059) 3157-5664,", [("phone", "(059) 3157-5664")]), ("Ligue 190 só em emergência", []),
    ("CPF nº 25083010285, morador", [("id_number", "25083010285")]), ("exibe CPF 249.527.389-28 e", [("id_number", "249.527.389-28")]), ("passaporte QX750240 e", [("id_number", "QX750240")]), ("NIF 756 611 585,", [("id_number", "756 611 585")]),
    ("documento 841 752 396 73, com", [("id_number", "841 752 396 73")]), ("título de eleitor 5328 6088 7112.", [("id_number", "5328 6088 7112")]), ("RG 14.470.845-0,", [("id_number", "14.470.845-0")]),
    ("O lote L99999999 e a Lei 14.132/2021", []), ("O protocolo 71.148-55/2939 foi", []), ("A edição 2538-2473 do boletim", []), ("código de barras 2435.2210 L33308477", []), ("R$ 69 para R$ 80.891.", []), ("Coordenadas: 86,2492 e 62,2866.", []),
    ("entregue na R. Dona Odila Vilarim 1063, segundo", [("address", "R. Dona Odila Vilarim 1063")]), ("na Av. das Andorinhas, nº 380, apto 49.", [("address", "Av. das Andorinhas, nº 380")]), ("Praça Professor Crispim Lindoso, n.º 23, 2.º Esq.", [("address", "Praça Professor Crispim Lindoso, n.º 23")]),
    ("A obra na Rua das Andorinhas parou em 7 de setembro de 2026.", []), ("Rua Quinze de Abril 1116.", [("address", "Rua Quinze de Abril 1116")]),
    ("Fale com o sr. mílton covalhã pelo número", [("name", "mílton covalhã")]), ("Testemunhas, entre elas NOÊMIA SERPANTO e Odila Zambujal Malvarosa, negaram", [("name", "NOÊMIA SERPANTO"), ("name", "Odila Zambujal Malvarosa")]),
    ("Segundo a dona Jucélia dos Pessegal, o boleto", [("name", "Jucélia dos Pessegal")]), ("“Meu nome é Genésio Serpanto e nunca assinei”", [("name", "Genésio Serpanto")]), ("lembra a dona da casa, que", []), ("enviada por Museu do Relevo ontem", []),
    ("[10:39] Belarmino dos Malvarosa: me chama", [("name", "Belarmino dos Malvarosa")]), ("El aviso lo envió Juvenal de Ourivaldes desde", [("name", "Juvenal de Ourivaldes")]), (None, []), ("", []),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_pieces(text, want):
    assert [(k, text[a:b]) for k, a, b in p.find(text)] == want


CUED = [
    "Seu Joao Silva", "D. Maria Souza", "disse.\nSeu Joao Silva", "“Seu Joao Silva", "(D. Maria Souza", "contato : Joao Silva", f"paciente{' ' * 60}: Joao Silva", "a Drª Maria Souza",
    "Dom. Joao Silva", "entre eles Joao Silva", "İ o Sr. Joao Silva", "İ Nome: Joao Silva", "TİTULAR: Joao Silva", "name\t: Joao Silva", "destinatária  : Maria Souza",
]


@pytest.mark.parametrize("text", CUED)
def test_cues_are_found_wherever_they_stand(text):
    assert [(k, text[a:b]) for k, a, b in p.find(text)] == [("name", text[-11:] if "Maria" in text else text[-10:])]


@pytest.mark.parametrize("sign", ["{a}", "<a>", "[ a ]", "( at )", "< at >", "(a )", "\u00a0at\n"])
def test_every_disguised_at(sign):
    text = f"escreva a ana.lima{sign}carta (dot) example"
    assert p.find(text) == [("email", 10, len(text))]


def test_a_letter_that_grows_in_lower_case():
    text = "İstanbul: Rua das Andorinhas, nº 380"
    assert p.find(text) == [("address", 10, len(text))]
    assert p.find("at 12 Baker\nStreet") == [("address", 3, 18)]


NEIGHBOURS = [
    ("(11) 91234-5678 / (11) 98765-4321", [("phone", "(11) 91234-5678"), ("phone", "(11) 98765-4321")]), ("11 91234-5678. 20 pessoas", [("phone", "11 91234-5678")]),
    ("sala #12 11 98765-4321", [("phone", "11 98765-4321")]), ("249.527.389-28 111.222.333-44", [("id_number", "249.527.389-28"), ("id_number", "111.222.333-44")]),
    ("CPF 249.527.389-28 / 111.222.333-44.", [("id_number", "249.527.389-28"), ("id_number", "111.222.333-44")]), ("CPF 25083010285 11 91234-5678", [("id_number", "25083010285"), ("phone", "11 91234-5678")]),
    ("841 752 396 73 5328 6088 7112", [("id_number", "841 752 396 73"), ("id_number", "5328 6088 7112")]), ("processo 1234 11 91234-5678", [("phone", "11 91234-5678")]),
    (" ".join(["11 91234-5678"] * 9), [("phone", "11 91234-5678")] * 9), ("passaporte AB12345, já", [("id_number", "AB12345")]), ("RG 1234567 (11) 3157-5664", [("id_number", "1234567"), ("phone", "(11) 3157-5664")]),
    ("código de barras 7891 2345 6789 0123", []), ("cartão 4111 1111 1111 1111", []), ("entre 10/05/2021 e 12 345 678 901 2", []), ("20 1234 5678 9012", []), ("RG 14.470.845-X, (11) 3157-5664", [("id_number", "14.470.845-X"), ("phone", "(11) 3157-5664")]), ("documento 5328 6088 7112 44 9", [("id_number", "5328 6088 7112 44 9")]),
]


@pytest.mark.parametrize(("text", "want"), NEIGHBOURS)
def test_neighbouring_numbers(text, want):
    assert [(k, text[a:b]) for k, a, b in p.find(text)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["seu", "D.", "Sr", "ª", "a", "Nome", " completo", "É", ":", "titular", "fale com", "[10:20]", "\n", " ", "  ", "(", "İ", "Ana Lima", "por", "assinado", "em nome de"]), max_size=12))
def test_quick_look_for_cues_loses_none(words):
    text = "".join(words)
    assert {m.end() for m in p._CUE.finditer(text) if p._name_at(text, m.end())} <= {a for k, a, _ in p.find(text) if k == "name"}


@settings(max_examples=150, deadline=None)
@given(st.text("0123456789", min_size=1, max_size=22), st.binary(min_size=1, max_size=8))
def test_feistel_round_trip(digits, key):
    f = p.Feistel(key)
    out = f.digits(digits, "t")
    assert len(out) == len(digits) and out.isdigit() and f.digits(out, "t", back=True) == digits


def test_feistel_is_a_permutation():
    f = p.Feistel(b"k")
    assert len({f.digits(f"{i:03d}") for i in range(1000)}) == 1000
    days = [dt.date(1999, 12, 1) + dt.timedelta(i) for i in range(400)]
    assert len({f.day(d) for d in days}) == 400 and all(1900 <= f.day(d).year <= 2099 for d in days) and f.day(dt.date(1700, 1, 1)) == dt.date(1700, 1, 1)


def test_mask_links_equal_values_and_keeps_the_rest():
    a, b = p.mask("CPF 249.527.389-28. Ligue para +55 (57) 9 5380-1466.", b"k"), p.mask("o CPF 24952738928 e e-mail x@y.example", b"k")
    digits = lambda t: "".join(c for c in t.split("]")[0] if c.isdigit())
    assert digits(a) == digits(b) and a.startswith("CPF [ID_NUMBER ") and "[PHONE +55 (" in a and a.endswith("].") and "[EMAIL " in b and "249" not in digits(a)[:3]
    assert p.mask("CPF 249.527.389-28", b"other") != p.mask("CPF 249.527.389-28", b"k") and p.mask(None, b"k") is None
    assert p.mask("Nascida em 01/02/1980.", b"k") != "Nascida em 01/02/1980." and p.mask("nascido em 31/02/1980", b"k") == "nascido em [DATE]"


def test_masked_text_holds_no_more_addresses_or_names():
    text = " ".join(t for t, _ in CASES if t)
    assert not [k for k, _, _ in p.find(p.mask(text, b"k")) if k in ("email", "name")]


def test_in_spark(spark):
    df = spark.createDataFrame([(1, "Dúvidas: a@b.example.", "x"), (1, None, None), (2, "😀 a@b.example" + " y" * 100000, None)], "doc_id long, text string, start long".replace("start long", "key string"))
    assert sorted(tuple(r) for r in p.found(df).collect()) == [(1, "email", 9), (2, "email", 2)]
    assert p.masked(df, "text", "secret").count() == 3 and p.found(df.limit(0)).count() == 0


def test_a_long_name_is_found_to_its_end():
    text = "Falei com o Sr. João Carlos Pedro Manuel Antunes Souza Lima, morador daqui."
    assert [text[s:e] for k, s, e in p.find(text) if k == "name"] == ["João Carlos Pedro Manuel Antunes Souza Lima"]


def test_numbers_keep_their_format_and_can_be_turned_back():
    feistel = p.Feistel(b"k")
    for value in ("249.527.389-28", "(57) 9 5380-1466"):
        digits = "".join(c for c in value if c.isdigit())
        moved = feistel.digits(digits, "id_number")
        assert len(moved) == len(digits) and moved != digits and feistel.digits(moved, "id_number", back=True) == digits
        shown = p.pseudonym("id_number", value, feistel)
        assert [c if not c.isdigit() else "0" for c in value] == [c if not c.isdigit() else "0" for c in shown[len("[ID_NUMBER ") : -1]]
