"""Verdicts: inferred from text, and mapped to a small taxonomy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlake.functions.text import squeeze

# Verdicts by the pattern that names them, the first that matches wins.  An accented "não é verdade"
# holds "é verdade" and so reads as true; ``strict_labels`` puts the denial first.
VERDICT_PATTERNS = (
    (r"\bverdade,?\s*mas\b", "Verdade, mas"),
    (r"\bimprecis[oa]\b", "Impreciso"),
    (r"\berrado\b", "Errado"),
    (r"\bverdadeir[oa]\b|\bé verdade\b|\btem raz[ãa]o\b", "Verdadeiro"),
    (r"\bfals[oa]\b|\bn[ãa]o [ée] verdade\b|\bboato\b|\bfake\b|\bhoax\b", "Falso"),
)

# Label keys of each class.
LABEL_KEYS = {
    "true": "verdadeiro certo fato comprovado praticamente_certo",
    "false": "falso errado fake montagem",
    "misleading": (
        "enganoso enganador falta_contexto fora_de_contexto sem_contexto descontextualizado distorcido nao_e_bem_assim exagerado esticado "
        "verdadeiro_mas impreciso insustentavel contraditorio"
    ),
    "unverified": "inconclusivo sem_provas sem_indicios sem_evidencias sem_evidencia sem_registro",
    "satire": "satira pimenta_na_lingua",
    "other": "checamos",
}
MISLEADING_PREFIXES = ("enganoso:", "contextualizando:")


def infer_verdict(*values: Column, strict_labels: bool = False) -> Column:
    """The verdict that the first value with any names; null if none does."""

    def one(value: Column) -> Column:
        text = F.lower(squeeze(value))
        out = F.when(text.rlike(r"(?U)\bn[ãa]o [ée] verdade\b"), "Falso") if strict_labels else None
        for pattern, verdict in VERDICT_PATTERNS:
            out = (F if out is None else out).when(text.rlike(f"(?U){pattern}"), verdict)
        return out

    return F.coalesce(*[one(v) for v in values])


def standard_label(label: Column, key: Column, prefix: Column, prefix_key: Column) -> Column:
    """The class of a cleaned label.  ``prefix`` is the part before a colon where the agency writes one, else the label."""
    classes = F.create_map(*[F.lit(x) for name, keys in LABEL_KEYS.items() for k in keys.split() for x in (k, name)])
    order = {name: i for i, name in enumerate(LABEL_KEYS)}
    rank = F.create_map(*[F.lit(x) for name, i in order.items() for x in (name, i)])
    by = lambda k: F.try_element_at(classes, F.coalesce(k, F.lit("")))
    a, b = by(prefix_key), by(key)
    # Membership of either key is tested class by class.
    first = F.when(F.coalesce(F.try_element_at(rank, F.coalesce(a, F.lit(""))), F.lit(99)) <= F.coalesce(F.try_element_at(rank, F.coalesce(b, F.lit(""))), F.lit(99)), a).otherwise(b)
    low = F.lower(prefix)
    return (
        F.when(label.isNull(), "missing")
        .when(prefix.rlike(r"(?i)^https?://|^\d+$"), "other")
        .when(first.isNotNull(), first)
        .when(F.startswith(low, F.lit(MISLEADING_PREFIXES[0])) | F.startswith(low, F.lit(MISLEADING_PREFIXES[1])), "misleading")
        .otherwise("other")
    )
