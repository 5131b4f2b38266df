import pytest

from claimlake.llm import residue as r

REAL = [
    "É falso que o erro 404 no portal de Barra Nova prove fraude", "JavaScript não rouba senhas de eleitores em Rio dos Juncos, dizem técnicos", "Não, “lorem ipsum” em cartaz de Vila Nova não é mensagem secreta",
    "Golpe usa falsa tela “verificando seu navegador” em Monte Alto", "Corrente diz que a mensagem de erro 503 do portal esconde 48.992 nomes; a conta mistura períodos distintos.",
    "Leitores pediram para checar se habilitar scripts no navegador expõe a prova do vestibular; o documento tem outro sentido.", "O vídeo tem 503 segundos e foi visto por 9 pessoas em Serra do Índigo.",
    "Acesso negado a moradores em Rio Fundo: vídeo é antigo", "Robô de Vila Rica não responde: entenda a falha 500",
]
RESIDUE = [
    ("{{titulo}}", "placeholder"), ("${item.name} fala", "placeholder"), ("Vídeo de Ilha Bela não mostra o mar <%= secao %>", "placeholder"), ("%(summary)s", "placeholder"), ("[INSERIR DATA] texto real aqui", "placeholder"),
    ("__TITULO__", "placeholder"), ("Checamos se x ({ano})", "placeholder"), ("xxxxx xxxx xxx", "placeholder"), ("Resumo resumo resumo resumo resumo.", "placeholder"), ("Sit amet consectetur adipiscing elit", "filler"),
    ("Lorem ipsum dolor sit amet", "filler"), ("Erro 404", "error"), ("HTTP 502: página não encontrada", "error"), ("Código de erro 504: muitas solicitações. Volte mais tarde.", "error"), ("503 SERVICE TEMPORARILY UNAVAILABLE", "error"),
    ("Request blocked. Reference 7a3f.", "error"), ("Ative o JavaScript", "script"), ("Sua conexão está sendo verificada antes de prosseguir. Ray ID 9c0e1.", "script"), ("  Verificando seu navegador\n", "script"),
    ("Seu navegador estÃ¡ desatualizado ou bloqueia scripts; libere-os e recarregue.", "script"), ("O áudio foi montado. Please enable JavaScript and cookies to continue.", "script"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None) for i, t in enumerate(rows)], "arrival long, title string, summary string")


def test_real_text_stays_and_residue_is_found(spark):
    rows = REAL * 3 + [t for t, _ in RESIDUE]
    found = {x["key"]: x["kind"] for x in r.residue(frame(spark, rows), "arrival", ["title", "summary"]).collect()}
    assert found == {len(REAL) * 3 + i: k for i, (_, k) in enumerate(RESIDUE)}


def test_tables_of_any_shape(spark):
    assert r.found(frame(spark, [])).count() == 0
    df = spark.createDataFrame([(1, None, " "), (1, "{{x}}", ""), (None, "ok" * 50000 + " {{x}}", None), (1, "{{x}}", "")], "arrival long, title string, summary string").withColumnRenamed("summary", "key")
    assert r.residue(df, "arrival", ["title", "key"]).count() == 3
    assert r.without_residue(df, ["title", "key"]).count() == 1


@pytest.mark.parametrize("text", ["preço de R$ 5 e 10%", "a <b>forte</b>", "[vídeo] antes", "50% de {1,2}", "#hashtag e @perfil", "x_y_z"])
def test_signs_are_no_placeholders(text):
    index = r.ExemplarIndex()
    index.weigh({}, 100)
    assert index.classify(text)[0] is None


def test_frequencies_count_what_is_compared(spark):
    index = r.ExemplarIndex({"error": ("Erro 404",)})
    fields = spark.createDataFrame([("Erro 12",), ("em 7 de maio",), ("sem nada",)], "value string")
    assert r._counts(fields, index) == ({"erro": 1, "0": 2}, 3)


@pytest.mark.parametrize("text", ["[FALSO] Vídeo mostra enchente em 2019", "[VÍDEO] Ministro disse isso", "Bla, bla, bla, bla: o discurso", "Guia de <SP> a <RJ>"])
def test_headlines_with_brackets_or_repeated_words_stay(text):
    index = r.ExemplarIndex()
    index.weigh({}, 100)
    assert index.classify(text)[0] is None
