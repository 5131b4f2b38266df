"""Template residue, filler and error-page text in place of (or beside) real content.

Method: labelled exemplars of residue are held in an inverted index from token to
exemplar.  A field is cut into passage windows; each window retrieves the
exemplars it shares tokens with, and TF-IDF containment is computed both ways:
how much of an exemplar stands in the window, and how much of the window the
retrieved exemplars cover.  A window that is covered for the most part is residue.
Unfilled placeholders become tokens of their own kind first.  A notation that
nothing but a template uses is an exemplar that counts beside any amount of real text;
bracketed capitals count so only if a template's word stands in them, and a word said
over and over is weighed in its window like all else.  Inverse document
frequencies are counted over all fields.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.llm.encoding import restore

# Labelled exemplars of text that stands where content should, by kind.
EXEMPLARS = {
    "filler": (
        "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua",
        "ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat",
        "duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur",
        "excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum",
        "sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium",
        "título da matéria (substituir)", "título do post 0", "insira o título", "insira o texto aqui", "digite o título",
        "headline goes here", "title goes here", "your text here", "insert text here", "texto do resumo vai aqui", "o título vai aqui",
        "insira aqui a linha fina com até 0 caracteres", "resumo da matéria aqui", "conteúdo de teste, favor ignorar",
        "isto é um teste, favor ignorar", "test content please ignore", "this is a test post", "texto de exemplo", "sample text",
        "escreva o resumo aqui", "título de exemplo", "sem título", "untitled document", "placeholder",
    ),
    "error": (
        "erro 0", "error 0", "http 0", "falha 0", "código de erro 0", "código 0", "404 not found", "not found", "page not found",
        "página não encontrada", "a página que você procura não existe ou foi movida", "a página solicitada não foi encontrada",
        "página indisponível", "conteúdo indisponível", "403 forbidden", "forbidden", "acesso negado", "acesso proibido", "access denied",
        "sem permissão para acessar esta página", "you don't have permission to access this page", "502 bad gateway – nginx",
        "bad gateway", "0 internal server error", "internal server error", "0 service temporarily unavailable", "service unavailable",
        "gateway timeout: o servidor de origem não respondeu (0)", "gateway timeout", "tempo esgotado", "request timeout",
        "servidor indisponível", "o servidor está temporariamente fora do ar", "tente novamente em 0 minutos", "volte mais tarde",
        "tente novamente mais tarde", "please try again later", "muitas solicitações", "too many requests", "request blocked", "reference 0",
        "erro 0: não foi possível completar a solicitação", "não foi possível completar a solicitação", "ops! algo deu errado",
        "something went wrong", "an error occurred while processing your request", "erro interno do servidor", "serviço indisponível",
        "error 0 ray id 0", "error establishing a database connection", "fatal error", "site em manutenção", "site under maintenance",
    ),
    "script": (
        "ative o javascript", "você precisa habilitar o javascript para continuar", "habilite o javascript no seu navegador",
        "este site requer javascript para funcionar corretamente", "please enable javascript and cookies to continue",
        "please enable javascript to view this page", "you need to enable javascript to run this app", "javascript is required",
        "noscript: para ver o texto, active os scripts do browser", "active o javascript no browser",
        "seu navegador está desatualizado ou bloqueia scripts; libere-os e recarregue", "seu navegador não suporta javascript",
        "verificando seu navegador", "checking your browser before accessing", "just a moment...", "attention required!",
        "sua conexão está sendo verificada antes de prosseguir", "ray id 0", "confirme que você não é um robô para seguir adiante",
        "verify you are human", "verifique que você é humano", "não sou um robô", "enable cookies", "ative os cookies para continuar",
    ),
    "placeholder": (
        "⟦{{⟧", "⟦{%⟧", "⟦<%⟧", "⟦${⟧", "⟦#{⟧", "⟦%%⟧", "⟦@@⟧", "⟦__⟧", "⟦[[⟧", "⟦{⟧", "⟦$⟧", "⟦%⟧", "⟦%(⟧", "⟦<⟧", "⟦[⟧", "⟦xx⟧", "⟦rep⟧",
    ),
}

#: A window is residue if exemplars cover this share of its weight, counting exemplars of which this share stands in it.
COVERED, CONTAINED = 0.7, 0.6

_NAME = r"[A-Za-zÀ-ÿ_][\wÀ-ÿ]*(?:[.\-][\wÀ-ÿ]+)*"
# Words that name what belongs in a template's slot, as they stand between brackets.
SLOTS = (
    "INSERIR INSIRA DIGITE PREENCHER SUBSTITUIR AQUI TÍTULO TITULO TITLE HEADLINE MANCHETE SUBTÍTULO RESUMO SUMMARY DESCRIÇÃO DESCRICAO DESCRIPTION TEXTO TEXT CORPO BODY "
    "DATA DATE ANO YEAR HORA TIME NOME NAME AUTOR AUTHOR USER USUÁRIO CIDADE CITY LOCAL PLACE SECAO SEÇÃO SECTION CATEGORIA AGENCY AGÊNCIA CLAIM ALEGAÇÃO LINK URL IMAGEM IMAGE "
    "LEGENDA FONTE SOURCE INSERT YOUR HERE PLACEHOLDER TODO TBD"
)
_SLOT = "(?:" + "|".join(SLOTS.split()) + ")"
#: Notations of unfilled placeholders and the token each becomes, the longest brackets first.
NOTATIONS = tuple(
    (f" ⟦{mark}⟧ ", rx)
    for mark, rx in (
        ("{{", r"\{\{\{?[^{}\n]*\}?\}\}"),
        ("{%", r"\{%[^{}%\n]*%\}"),
        ("<%", r"<%[=\-]?[^<>%\n]*%>"),
        ("${", r"\$\{[^{}\n]*\}"),
        ("#{", r"#\{[^{}\n]*\}"),
        ("[[", rf"\[\[\s*{_NAME}\s*\]\]"),
        ("%%", rf"%%{_NAME}%%"),
        ("@@", rf"@@{_NAME}@@"),
        ("__", r"(?<!\w)__[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9.]*(?:_[A-Za-zÀ-ÿ0-9.]+)*__(?!\w)"),
        ("%(", rf"%\({_NAME}\)[sdrif]"),
        ("{", rf"\{{\s*(?:{_NAME}|\d{{1,2}})\s*\}}"),
        ("$", rf"\$[A-Za-z_][A-Za-z_.]+\$"),
        ("%", r"(?<![\w%])%[A-Z_]{2,}%(?!\w)"),
        ("<", rf"<(?:[A-ZÀ-Ý]+[ _.])*{_SLOT}(?:[ _.][A-ZÀ-Ý]+)*>|<[A-Z]+(?:[_.][A-Z]+)+>"),
        ("[", rf"\[(?:[A-ZÀ-Ý]+[ _.])*{_SLOT}(?:[ _.][A-ZÀ-Ý]+)*\]|\[[A-Z]+(?:[_.][A-Z]+)+\]"),
        ("xx", r"(?i)(?<!\w)x{3,}(?:[\s.,]+x{3,})+(?!\w)"),
        ("rep", r"(?i)(?<!\w)([^\W\d_]{3,})(?:[\s,.]+\1){3,}(?!\w)"),
    )
)
_NOTATIONS = tuple((mark, re.compile(rx)) for mark, rx in NOTATIONS)
_SOME = re.compile(r"[{}<>%$#@_\[\]]|(?i:x{3}|(\b\w{3,})\W+\1\W+\1)")
_TOKEN = re.compile(r"⟦[^⟧]+⟧|(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{4,}|\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)?")
_MARK = re.compile("⟦[^⟧]+⟧")
_DIGIT = re.compile(r"\d")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|[\n\r|]+|\s[-–—]\s")


def tokens(text: str) -> list[str]:
    """Lower-case words, ``0`` for numbers and hexadecimal ids, one token per placeholder."""
    return ["0" if t[0] != "⟦" and not t.isalpha() and _DIGIT.search(t) else t for t in _TOKEN.findall(text)]


def _mark(text: str) -> str:
    text = restore(text)[1]
    if _SOME.search(text):
        for mark, rx in _NOTATIONS:
            text = rx.sub(mark, text)
    return text.lower()


class ExemplarIndex:
    """The exemplars' tokens, and from each token the exemplars that hold it."""

    def __init__(self, exemplars: dict[str, tuple[str, ...]] = EXEMPLARS) -> None:
        self.items = [(kind, Counter(tokens(text.lower()))) for kind, texts in exemplars.items() for text in texts]
        self.postings: dict[str, list[int]] = {}
        for n, (_, bag) in enumerate(self.items):
            for t in bag:
                self.postings.setdefault(t, []).append(n)
        self.known = frozenset(self.postings)

    def weigh(self, frequency: dict[str, int], fields: int) -> None:
        """IDF from document frequencies over all fields; a token that isn't the index's own weighs as much as a rare one."""
        self.idf = {t: math.log(1 + (fields + 1) / (frequency.get(t, 0) + 1)) for t in self.known}
        ranked = sorted(self.idf.values())
        self.other = ranked[len(ranked) // 2] if ranked else 1.0

    def match(self, window: Counter) -> tuple[float, str]:
        """Share of the window that retrieved exemplars cover, and the kind of the best of them."""
        total = possible = 0.0
        for t, n in window.items():
            w = self.idf.get(t)
            total += (self.other if w is None else w) * n
            possible += 0.0 if w is None else w * n
        # No exemplar can cover more than the tokens that any exemplar has.
        if possible < COVERED * total:
            return 0.0, ""
        candidates = {n for t in window for n in self.postings.get(t, ())}
        cover: Counter = Counter()
        best = (0.0, "")
        for n in candidates:
            kind, bag = self.items[n]
            shared = {t: min(c, window[t]) for t, c in bag.items() if t in window}
            mass = sum(self.idf[t] * c for t, c in shared.items())
            contained = mass / sum(self.idf[t] * c for t, c in bag.items())
            # Filler is quoted in part: three words of it in the window count as the passage.
            if contained >= CONTAINED or (kind == "filler" and len(bag) > 8 and sum(shared.values()) >= 3):
                for t, c in shared.items():
                    cover[t] = max(cover[t], window[t] if kind == "filler" else c)
                best = max(best, (mass, kind))
        covered = sum(self.idf[t] * min(c, window[t]) for t, c in cover.items())
        return (covered / total if total else 0.0), best[1]

    def classify(self, text: str | None) -> tuple[str | None, float, str | None]:
        """``(kind, score, window)`` of a field's most residual window; kind is None for real text."""
        if not text or not text.strip():
            return None, 0.0, None
        marked = _mark(text)
        best: tuple[str | None, float, str | None] = (None, 0.0, None)
        if any(self.items[n][0] == "placeholder" for t in _MARK.findall(marked) if t != "⟦rep⟧" for n in self.postings.get(t, ())):
            return "placeholder", 1.0, text
        windows = [marked, *(w for w in _SENTENCE.split(marked) if w and w != marked)]
        for w in windows:
            bag = Counter(tokens(w))
            if not bag or not (self.known & bag.keys()):
                continue
            score, kind = self.match(bag)
            if score > best[1]:
                best = (kind if score >= COVERED else None, score, w)
        return best


_RESULT = T.StructType().add("kind", "string").add("score", "double").add("window", "string")


def _counts(fields: DataFrame, index: ExemplarIndex) -> tuple[dict[str, int], int]:
    """Document frequencies of the index's tokens, as ``classify`` compares them, over all fields; as many rows as the index has tokens."""
    known = index.known

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            seen["⟦n⟧"] += len(batch)
            for text in batch["value"]:
                seen.update(known.intersection(tokens(_mark(text))))
        yield pd.DataFrame({"token": list(seen), "n": list(seen.values())}).astype({"token": str, "n": "int64"})

    rows = fields.select("value").mapInPandas(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    found = {r["token"]: r["n"] for r in rows}
    return found, found.pop("⟦n⟧", 0)


def _index(long: DataFrame, exemplars: dict[str, tuple[str, ...]]) -> ExemplarIndex:
    index = ExemplarIndex(exemplars)
    index.weigh(*_counts(long, index))
    return index


def _classifier(index: ExemplarIndex):  # noqa: ANN202
    @F.pandas_udf(_RESULT)
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([index.classify(t) for t in texts], columns=["kind", "score", "window"])

    return classify


def _long(df: DataFrame, fields: list[str], *key: Column) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields])
    long = df.select(*key, F.explode(F.filter(pairs, lambda p: F.length(F.trim(p["value"])) > 0)).alias("p"))
    return long.select(*(["key"] if key else []), F.col("p.field").alias("field"), F.col("p.value").alias("value"))


def residue(df: DataFrame, key: str, fields: list[str], exemplars: dict[str, tuple[str, ...]] = EXEMPLARS) -> DataFrame:
    """``key, field, kind, score, window`` for each field that holds residue.

    Null and blank fields are none; garbled text is compared as restored; repeated
    rows give repeated rows; whatever its length a field is read to its end.
    """
    long = _long(df, fields, F.col(f"`{key}`").alias("key"))
    done = long.select("key", "field", _classifier(_index(long, exemplars))("value").alias("r"))
    return done.filter("r.kind is not null").select("key", "field", "r.kind", "r.score", "r.window")


def without_residue(df: DataFrame, fields: list[str], exemplars: dict[str, tuple[str, ...]] = EXEMPLARS) -> DataFrame:
    """The rows of which no field holds residue; each row is judged where it lies."""
    classify = _classifier(_index(_long(df, fields), exemplars))
    bad = F.lit(False)
    for f in fields:
        bad = bad | classify(F.col(f"`{f}`"))["kind"].isNotNull()
    return df.filter(~bad)


def found(items: DataFrame) -> DataFrame:
    """``arrival, field`` of every title or summary that holds residue."""
    return residue(items, "arrival", ["title", "summary"]).select(F.col("key").alias("arrival"), "field")
