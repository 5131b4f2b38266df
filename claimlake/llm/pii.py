"""Personal information inside free text: e-mail addresses, phone and identity numbers, street addresses, names.

Method: recognisers find the pieces; each is replaced by a placeholder of its type.
Numbers and dates keep a format-preserving pseudonym inside the placeholder: their
digits go through a keyed Feistel permutation of all strings of the same length, so
equal values stay linked across documents (whatever their punctuation), different
ones stay apart, and only the key reverses it.  Other kinds carry a keyed tag.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "phone", "id_number", "address", "name")

# Words before a number that make it an identity number; words before one that make it neither kind.
ID_LABELS = (
    "cpf", "rg", "nif", "nie", "dni", "cnh", "pis", "nis", "nit", "bi", "documento", "identidade", "carteira de identidade", "passaporte",
    "pasaporte", "passport", "título de eleitor", "titulo de eleitor", "cartão de cidadão", "cartao de cidadao", "cartão cidadão", "ssn",
    "identity card", "id number", "id card", "cédula", "cedula", "contribuinte", "segurança social", "document", "inscrição",
)
OTHER_LABELS = (
    "lei", "decreto", "lote", "protocolo", "processo", "edição", "edicao", "barras", "r$", "portaria", "coordenadas", "cena", "isbn", "issn",
    "resolução", "artigo", "nota fiscal", "pedido", "contrato", "ley", "law", "lot", "cnpj", "ação", "autos", "inquérito", "medida provisória", "edital",
)

# Words for a street.
STREETS = (
    "rua", "r.", "avenida", "av.", "av", "travessa", "tv.", "trav.", "alameda", "al.", "praça", "praca", "pça.", "pç.", "largo", "lgo.", "estrada", "estr.",
    "rodovia", "rod.", "beco", "ladeira", "viela", "calçada", "quinta", "praceta", "calle", "c/", "avda.", "plaza", "paseo", "carrera",
)
_STREETS = tuple(sorted(STREETS, key=len, reverse=True))
STREETS_AFTER = ("street", "st.", "road", "rd.", "avenue", "ave.", "lane", "drive")

# What announces a person's name, in Portuguese, Spanish and English.
NAME_CUES = (
    r"\b(?:o |a |ao |à |do |da |el |la |don |com o |com a )?(?:sr|sra|srta|dr|dra|prof|profa|mr|mrs|ms|dom|d)\.?ª? ",
    r"\b(?:senhor|senhora|dona|doña|doutor|doutora|seu|señor|señora) ",
    r"\bfal(?:ar|e|ou|ei|amos) com ", r"\bentre (?:elas|eles|ellos|ellas),? ", r"\b(?:assinatura|firma) de ", r"\b(?:assinad[oa]|firmad[oa]) por ",
    r"\b(?:meu|seu|mi|su) nome é ", r"\bnome(?: completo)?(?: é|:) ", r"\bmi nombre es ", r"\bmy name is ", r"\bme chamo ", r"\bme llamo ",
    r"\b(?:enviad[oa]|mandad[oa]|escrit[oa]|recebid[oa]|encaminhad[oa]) por ", r"\blo envió ", r"\bthe sender, ", r"\b(?:signed|sent|written) by ",
    r"\b(?:remetente|destinatári[oa]|titular|responsável|contato|assinante|remitente|sender|nome|nombre|name|paciente|morador|cliente)\s*: ",
    r"\bem nome de ", r"\ba nombre de ", r"\btitular(?: é|,)? ", r"\bin the name of ", r"\bask for ", r"\bpregunte por ", r"\bprocur(?:e|ar) por ",
    r"\[\d{1,2}[:h]\d{2}(?::\d{2})?(?: [AP]M)?\] ?(?:~ ?)?", r"(?:^|\n)\d{1,2}/\d{1,2}/\d{2,4},? \d{1,2}:\d{2} - ",
    r"\b(?:speak|talk) (?:to|with) ", r"\bhablar con ",
)

# Words that begin the name of an institution or a place, and words that end a name in lower case.
NOT_PERSONS = frozenset(
    "defesa museu hospital instituto universidade câmara tribunal conselho agência companhia laboratório fundação federação sociedade secretaria "
    "ouvidoria ouvidoria-geral polícia vigilância autoridade junta centro arquivo observatório rede prefeitura ministério governo escola igreja banco "
    "associação comissão departamento empresa jornal portal redação equipe núcleo mesa vila serra monte lago ilha barra campo porto rio são santa santo "
    "nova ponte pedra furna castelo água morro cabo areia vale alto ribeirão três praça rua avenida travessa brasil portugal angola lisboa universidad "
    "ayuntamiento ministerio the este esta esse essa aquele el la los las un una o a os as um uma que quem todos nós eles elas it this that".split()
)
_ENDS = frozenset(
    "e y and pelo pela pelos pelas por para com que quem o a os as no na nos nas em ao à desde used usou sent from who, cuja cujo disse negou negaram nunca "
    "recibió con al el la los las un una or ou se foi é era está tem the to of at on in is was said via até sobre como quando mas morador moradora "
    "cpf rg nif documento passaporte título telefone email e-mail endereço".split()
)
_LINKS = frozenset("de da do dos das di del della van von y la".split())

_AT = r"(?:@|\s@\s|\s?[\[({<]\s?(?:arroba|at|a|@)\s?[\])}>]\s?|\s(?:arroba|at)\s)"
_DOT = r"(?:\.|\s?[\[({<]\s?(?:ponto|punto|dot|\.)\s?[\])}>]\s?|\s(?:ponto|punto|dot)\s)"
_EMAIL = re.compile(rf"(?i)(?<![\w.+%-])[a-z0-9À-ÿ][\wÀ-ÿ.+%-]*{_AT}[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:{_DOT}[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)+(?![\w@])")
#: Runs of numbers are looked for by their digits; each number in one is then widened to what belongs to it on the left.
_RUN = re.compile(r"\d[\d .\-()/]{3,}[\dXx]")
_TOKEN = re.compile(r"\d+(?:-?[Xx](?![\w@]))?")
_LEAD = re.compile(r"(?:\+ ?\(?|\(\+?|[A-Z]{1,3}-?)$")
#: What a number looks like, and what may not stand behind one.
_NUMBER = re.compile(r"[A-Z]{1,3}-?\d{5,9}|(?:\+ ?|00)?\(?\+?\d[\d .\-()/]{5,24}[\dXx]")
_GOES_ON = re.compile(r"[\w@]|[./,-]\d")
_PHONES = tuple(
    re.compile(rx)
    for rx in (
        r"(?:\+ ?|00) ?\d{1,3}[ .\-]?\(?0?\d{2,3}\)?[ .\-]?\d?[ .\-]?\d{3,5}[ .\-]?\d{4}",  # country code, area code, number
        r"(?:\+ ?|00) ?\d{1,3}[ .\-]?\d{3}[ .\-]?\d{3}[ .\-]?\d{3}",  # country code and nine digits
        r"\(0?\d{2,3}\) ?\d?[ .\-]?\d{3,5}[ .\-]?\d{4}",
        r"0?\d{2}[ .\-]9?[ .\-]?\d{4,5}[ .\-]\d{4}",
        r"\d{3}-\d{3}-\d{3,4}",
        r"9?\d{4}-\d{4}",
        r"0?\d{2}9?\d{8}",
        r"[29]\d{2} ?\d{3} ?\d{3}",
        r"0[38]00[ .\-]?\d{3}[ .\-]?\d{4}",
    )
)
_IDS = tuple(
    re.compile(rx)
    for rx in (r"\d{3}\.\d{3}\.\d{3}[-.]\d{2}", r"\d{3} \d{3} \d{3} \d{2}", r"\d{1,2}\.\d{3}\.\d{3}-[\dXx]", r"\d{4} \d{4} \d{4}", r"\d{3}\.\d{5}\.\d{2}-\d")
)
_EXACT = re.compile("|".join(f"(?:{rx.pattern})" for rx in (*_PHONES, *_IDS)))
#: Forms that are an identity number only after a word that says so.
_ID_FORMS = re.compile(r"[A-Z]{1,3}-?\d{5,9}|\d[\d .\-]{4,18}[\dXx]")
_ID_BEFORE = re.compile(r"(?i)(?<!\w)(?:%s)\b[^\w\n]{0,3}(?:n\.?\s?[º°o.]{0,2}\s?|número\s|numero\s|number\s|no\.\s|nº\s)?[^\w\n]{0,2}$" % "|".join(sorted(map(re.escape, ID_LABELS), key=len, reverse=True)))
_OTHER_BEFORE = re.compile(r"(?i)(?<!\w)(?:%s)(?!\w)(?:\s(?:n\.?\s?[º°o.]{0,2}|número|federal|complementar|de|da))?[^\w\n]{0,3}$" % "|".join(sorted(map(re.escape, OTHER_LABELS), key=len, reverse=True)))
_CAP = r"(?:[A-ZÀ-ÖØ-Þ][\wÀ-ÿ'’-]*\.?|\d{1,2}(?= de ))"
_LINK = r"(?:de|da|do|das|dos|e|del|la|of|DE|DA|DO|DAS|DOS|E)"
_HOUSE = r"(?:\s?,\s?(?:n\.?\s?[º°o]\.?\s?|número\s|num\.\s|#\s?)?|\s(?:n\.?\s?[º°o]\.?\s?|número\s)?)\d{1,5}(?:-?[A-Za-z]\b)?"
_ADDRESS = re.compile(rf"\s(?:{_LINK}\s)*{_CAP}(?:\s(?:{_LINK}\s)*{_CAP}){{0,5}}{_HOUSE}(?![\w]|[.,:/h]\d|\s(?:de|horas)\s)")
#: Written in lower case or without capitals, a street needs a comma or a number sign before the house number.
_ADDRESS_LOW = re.compile(r"\s[^\W\d_][^\W\d_'’-]*(?:\s[^\W\d_]+){0,5}(?:\s?,\s?(?:n\.?\s?[º°o]\.?\s?)?|\s(?:n\.?\s?[º°]\.?|número)\s?)\d{1,5}(?![\w]|[.,:/h]\d|\s(?:de|horas)\s)")
_ADDRESS_EN = re.compile(rf"(?<![\w@.])\d{{1,5}}\s{_CAP}(?:\s{_CAP}){{0,3}}\s(?i:{'|'.join(re.escape(s) for s in STREETS_AFTER)})(?!\w)")
_CUE = re.compile("(?i)(?:%s)" % "|".join(NAME_CUES))
#: No cue without one of these at the beginning of a word (or anywhere, the bracket); most texts have few.
_CUE_PARTS = (
    "sr", "dr", "mr", "ms", "prof ", "prof.", "profª", "profa", "dom ", "dom.", "domª", "d ", "d.", "dª", "senhor", "dona ", "doña ", "doutor", "seu ", "señor",
    "falar com", "fale com", "falou com", "falei com", "falamos com", "entre el", "assinatura de", "firma de", "assinado por",
    "assinada por", "firmado por", "firmada por", "nome", "nombre", "name", "me chamo", "me llamo", "enviado por", "enviada por", "mandado por", "mandada por",
    "escrito por", "escrita por", "recebido por", "recebida por", "encaminhado por", "encaminhada por", "lo envió", "the sender", "signed by", "sent by",
    "written by", "remetente", "destinatári", "titular", "responsável", "contato", "assinante", "remitente", "sender", "paciente", "morador", "cliente",
    "ask for", "pregunte por", "procure por", "procurar por", "speak to", "speak with", "talk to", "talk with", "hablar con", "[",
)
#: Between the part and the colon of a cue.
_TO_COLON = re.compile(r"\w?\s*")
#: No "at" of a disguised address without one of these, an "@" or an "arroba".
_AT_WORD = re.compile(r"[\[({<]\s?at?\s?[\])}>]|\sat\s")
#: Letters that match a plain one when case is ignored, though their lower case is another or longer.
_PLAIN = {"İ": "i", "ı": "i", "ſ": "s"}
_CLOCK_LINE = re.compile(r"\d:\d{2} - ")
_NAME_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_BIRTH = re.compile(r"(?i)\b(?:nascid[oa](?: em)?|nascimento:?|d\.?n\.?:?|nacid[oa](?: el)?|born(?: on)?)\s+(\d{1,2}[/.-]\d{1,2}[/.-]\d{4})")


def _name_at(text: str, at: int) -> int | None:
    """The end of a person's name that begins at ``at``; None if there is no name."""
    end, count, style, place = at, 0, "", at
    while True:
        m = _NAME_WORD.match(text, place)
        if not m:
            break
        word = m.group()
        low = word.lower()
        if low in _LINKS and count and low not in ("y", "la"):
            place = m.end() + 1
            if text[m.end() : m.end() + 1] != " ":
                break
            continue
        kind = "upper" if word.isupper() and len(word) > 1 else "title" if word[0].isupper() else "low"
        if not count:
            if low in NOT_PERSONS or low in _ENDS or low in _LINKS:
                return None
            style = kind
        elif kind != style or low in _ENDS:
            break
        count, end = count + 1, m.end()
        if text[end : end + 1] != " ":
            break
        place = end + 1
    # One word alone is no name that could be told from a noun; letters or signs right behind it make it something else.
    if count < 2 or re.match(r"[@+\w]", text[end : end + 1]):
        return None
    if style == "low" and not re.match(r"\s*(?:[,.;:)\n”\"]|$|(?:%s)\b)" % "|".join(sorted(_ENDS, key=len, reverse=True)), text[end:]):
        return None
    return end


def find(text: str | None, dates: bool = False) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the pieces of personal data, in order and without overlaps; offsets in characters."""
    if not text:
        return []
    taken: list[tuple[str, int, int]] = []

    def free(start: int, end: int) -> bool:
        return all(end <= s or start >= e for _, s, e in taken)

    # Offsets in lower case are those of the text: only the lower case of "İ" is longer.
    low = text
    for letter, plain in _PLAIN.items():
        low = low.replace(letter, plain)
    low = low.lower()
    if "@" in text or "arroba" in low or _AT_WORD.search(low):
        for m in _EMAIL.finditer(text):
            if not re.search(r"(?i)\sat\s", m.group()) or re.search(r"(?i)\sdot\s|\(dot\)|\[dot\]", m.group()):
                taken.append(("email", *m.span()))
    for word in _STREETS:
        at = low.find(word)
        while at >= 0:
            end = at + len(word)
            if (not at or not (text[at - 1].isalnum() or text[at - 1] in "_@.")) and text[end : end + 1].isspace():
                rest = _ADDRESS.match(text, end) or _ADDRESS_LOW.match(text, end)
                if rest and free(at, rest.end()):
                    taken.append(("address", at, rest.end()))
            at = low.find(word, end)
    if any(s in low for s in STREETS_AFTER):
        taken += [("address", *m.span()) for m in _ADDRESS_EN.finditer(text) if free(*m.span())]
    if dates:
        taken += [("date", *m.span(1)) for m in _BIRTH.finditer(text)]
    for run in _RUN.finditer(text):
        taken += [piece for piece in _numbers(text, *run.span()) if free(*piece[1:])]
    _names(text, low, taken, free)
    return sorted(taken, key=lambda x: x[1])


def _names(text: str, low: str, taken: list[tuple[str, int, int]], free: Callable[[int, int], bool]) -> None:
    """Adds the names that a cue announces, and those that go on in a list."""
    starts = set()
    for part in _CUE_PARTS:
        at = low.find(part)
        while at >= 0:
            # The cue lies around its part, whatever the blanks before its colon.
            if part == "[" or not at or not (low[at - 1].isalnum() or low[at - 1] == "_"):
                end = at + len(part)
                starts.update(m.end() for m in _CUE.finditer(text, max(0, at - 16), max(end + 24, _TO_COLON.match(text, end).end() + 2)))
            at = low.find(part, at + 1)
    starts.update(m.end() for m in _CLOCK_LINE.finditer(text))
    for start in sorted(starts):
        while (end := _name_at(text, start)) is not None:
            if free(start, end):
                taken.append(("name", start, end))
            more = re.match(r"(?:,| e| y| and|,? e| &) ", text[end:])
            if not more:
                break
            start = end + more.end()
            # After a comma only a name in the list goes on; a lower-case word there is the sentence.
            if not text[start : start + 1].isupper() and more.group().strip() == ",":
                break


def _numbers(text: str, first: int, last: int) -> list[tuple[str, int, int]]:
    """The phone and identity numbers of a run of numbers, each the longest that begins where it does.

    Groups of digits with blanks between them might be a part of a longer number: such
    a piece has no other digits a blank away, unless they are a piece of their own.
    """
    tokens = [m.span() for m in _TOKEN.finditer(text, first, last)]
    best: dict[int, tuple[str, int, int]] = {}
    # From the right, so that what follows a piece is known.
    for i in range(len(tokens) - 1, -1, -1):
        at = tokens[i][0]
        lead = _LEAD.search(text, max(0, at - 4), at)
        start = lead.start() if lead else at
        if start and (text[start - 1].isalnum() or text[start - 1] in "_@#/.,+-"):
            continue
        before = text[max(0, start - 40) : start]
        labels = None
        # No number has more tokens than _NUMBER has characters.
        ends = [k for k in range(i, min(i + 30, len(tokens))) if not _GOES_ON.match(text, tokens[k][1])]
        for exact in (True, False):
            for k in reversed(ends):
                value = text[start : tokens[k][1]]
                if not _NUMBER.fullmatch(value) or not (_EXACT if exact else _ID_FORMS).fullmatch(value):
                    continue
                if labels is None:
                    labels = bool(_OTHER_BEFORE.search(before)), bool(_ID_BEFORE.search(before))
                kind = _number_kind(value, before, *labels) if exact or labels[1] else None
                # What only its label makes an identity number doesn't reach into a piece behind it.
                inner = not exact and any(best[j][2] >= tokens[k][1] for j in range(i + 1, k + 1) if j in best)
                part = exact and _loose(value) and _touches(text, tokens, k) and k + 1 not in best
                if kind and not inner and not part:
                    best[i] = kind, start, tokens[k][1]
                    break
            if i in best:
                break
    pieces_: list[tuple[str, int, int]] = []
    for i, piece in sorted(best.items()):
        end = pieces_[-1][2] if pieces_ else -1
        if piece[1] >= end and not (i and _loose(text[piece[1] : piece[2]]) and _touches(text, tokens, i - 1) and tokens[i - 1][1] != end):
            pieces_.append(piece)
    return pieces_


def _loose(value: str) -> bool:
    """Whether a number is held together by blanks alone."""
    return " " in value and value.replace(" ", "").isdigit()


def _touches(text: str, tokens: list[tuple[int, int]], k: int) -> bool:
    """Whether only a blank stands between two tokens of a run."""
    return k + 1 < len(tokens) and text[tokens[k][1] : tokens[k + 1][0]] == " "


def _number_kind(value: str, before: str, other: bool, labelled: bool) -> str | None:
    if other:
        return None
    if labelled and _ID_FORMS.fullmatch(value):
        return "id_number"
    if any(rx.fullmatch(value) for rx in _IDS):
        return "id_number"
    if any(rx.fullmatch(value) for rx in _PHONES):
        digits = re.sub(r"\D", "", value)
        # Nine digits in groups of three are a phone number only with a code or after a word for one.
        if len(digits) in (8, 9) and "-" not in value or re.fullmatch(r"\d{4}-\d{4}", value):
            return "phone" if re.search(r"(?i)(?:tel|fone|telem|cel|whats|zap|lig|llam|call|número|contat|phone|fax)\w*\W{0,3}(?:\w{1,4}\W)?$", before) else None
        return "phone"
    return None


class Feistel:
    """A keyed permutation of the digit strings of each length (and of the days of a range of years)."""

    def __init__(self, key: bytes, rounds: int = 10) -> None:
        self.key, self.rounds = key, rounds

    def _round(self, n: int, tweak: str, i: int, half: str, modulus: int) -> int:
        message = f"{n}|{tweak}|{i}|{half}".encode()
        return int.from_bytes(hmac.new(self.key, message, hashlib.sha256).digest()[:16]) % modulus

    def digits(self, value: str, tweak: str = "", back: bool = False) -> str:
        """Permutes a string of digits among those of its length; ``back`` reverses it."""
        n = len(value)
        if n < 2:
            return str((int(value) + (-1 if back else 1) * self._round(n, tweak, 0, "", 10)) % 10) if value else value
        u = n // 2
        v = n - u
        a, b = value[:u], value[u:]
        for i in range(self.rounds) if not back else reversed(range(self.rounds)):
            m = u if i % 2 == 0 else v
            if not back:
                c = (int(a) + self._round(n, tweak, i, b, 10**m)) % 10**m
                a, b = b, f"{c:0{m}d}"
            else:
                c = (int(b) - self._round(n, tweak, i, a, 10**m)) % 10**m
                a, b = f"{c:0{m}d}", a
        return a + b

    def day(self, date: dt.date, first: int = 1900, last: int = 2099) -> dt.date:
        """Permutes the days of a range of years; a day outside it stays."""
        low, high = dt.date(first, 1, 1).toordinal(), dt.date(last, 12, 31).toordinal()
        n = high - low + 1
        if not low <= date.toordinal() <= high:
            return date
        width, x = len(str(n - 1)), date.toordinal() - low
        while True:  # walk the cycle until it is back in range
            x = int(self.digits(f"{x:0{width}d}", "day"))
            if x < n:
                return dt.date.fromordinal(low + x)


def pseudonym(kind: str, value: str, feistel: Feistel) -> str:
    """The placeholder of one piece."""
    if kind in ("phone", "id_number"):
        code = re.match(r"(?:\+ ?|00 ?)(?:55|351|244|34|1|44)", value) if kind == "phone" else None
        keep = code.end() if code else 0
        digits = re.sub(r"\D", "", value[keep:])
        fresh = iter(feistel.digits(digits, kind))
        return f"[{kind.upper()} {value[:keep]}{''.join(next(fresh) if c.isdigit() else c for c in value[keep:])}]"
    if kind == "date":
        d, m, y = map(int, re.split(r"[/.-]", value))
        try:
            moved = feistel.day(dt.date(y, m, d))
        except ValueError:  # no such day
            return "[DATE]"
        return f"[DATE {moved:%d}{value[-5]}{moved:%m}{value[-5]}{moved:%Y}]"
    tag = hmac.new(feistel.key, f"{kind}|{' '.join(value.lower().split())}".encode(), hashlib.sha256).hexdigest()[:8]
    return f"[{kind.upper()} {tag}]"


def mask(text: str | None, key: bytes, dates: bool = True) -> str | None:
    """The text with typed placeholders in place of personal data."""
    if not text:
        return text
    feistel, out, at = Feistel(key), [], 0
    for kind, start, end in find(text, dates):
        out += [text[at:start], pseudonym(kind, text[start:end], feistel)]
        at = end
    return "".join(out) + text[at:]


_FOUND = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))


@F.pandas_udf(_FOUND)
def _find_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in texts])


def pieces(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, kind, start, end`` of every piece; null and blank texts have none."""
    found_ = df.select(F.col(f"`{key}`").alias("key"), F.explode(_find_udf(F.col(f"`{text}`"))).alias("p"))
    return found_.select("key", "p.kind", "p.start", "p.end")


def masked(df: DataFrame, text: str, key: str) -> DataFrame:
    """The table with ``text`` masked under the secret ``key``; every row stays."""
    secret = key.encode()

    @F.pandas_udf(T.StringType())
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([mask(t, secret) for t in texts])

    return df.withColumn(text, apply(F.col(f"`{text}`")))


def found(documents: DataFrame) -> DataFrame:
    """``doc_id, kind, start_pos`` of every piece of personal data."""
    return pieces(documents, "doc_id", "text").select(F.col("key").alias("doc_id"), "kind", F.col("start").alias("start_pos"))
