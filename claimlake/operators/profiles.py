"""Rules of single agencies for the analysis snapshot: a small dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The standing order of spiders.
SPIDER_ORDER = (
    "afp_checamos", "agencia_lupa", "aos_fatos", "boatos_org", "e_farsas", "estadao_verifica", "g1_fato_ou_fake", "observador", "poligrafo",
    "projeto_comprova", "publico", "reuters_fact_check", "uol_confere",
)

# The cleaning steps that all spiders go through.
BASE_FLAGS = ("html_unescape", "unicode_normalize", "collapse_whitespace", "light_encoding_fix")

# Display names, and what differs from the default for single spiders.
DISPLAY_NAMES = {
    "afp_checamos": "AFP Checamos", "agencia_lupa": "Agencia Lupa", "aos_fatos": "Aos Fatos", "boatos_org": "Boatos.org", "e_farsas": "E-farsas",
    "estadao_verifica": "Estadao Verifica", "g1_fato_ou_fake": "G1 Fato ou Fake", "observador": "Observador", "poligrafo": "Poligrafo",
    "projeto_comprova": "Projeto Comprova", "publico": "Publico", "reuters_fact_check": "Reuters Fact Check", "uol_confere": "UOL Confere",
}
FIELD_ORDER = {"observador": ("claim", "summary", "title")}
IGNORED_TITLES = {"observador": ("observador",)}
DROPPED_TITLES = {"afp_checamos": ("como trabalhamos",), "aos_fatos": ("ultimas noticias", "últimas notícias")}
PREFIX_LABELS = ("projeto_comprova",)
DIAGNOSTIC_RUNS = {"uol_confere": ("20260315T010005Z-1d265f16", "20260314T232736Z-2cced5c3")}
EXTRA_FLAGS = {
    "afp_checamos": ("drop_generic_editorial_titles",),
    "aos_fatos": ("drop_generic_editorial_titles",),
    "g1_fato_ou_fake": ("direct_fake_fato_mapping",),
    "observador": ("ignore_generic_title_in_analysis", "claim_summary_priority"),
    "projeto_comprova": ("extract_verdict_prefix",),
    "publico": ("parse_rfc822_dates",),
    "uol_confere": ("diagnose_empty_latest_run",),
}

#: Used for spiders without rules of their own.
DEFAULT_ORDER = ("title", "claim", "summary")

SCHEMA = (
    "spider string, display_name string, field_order array<string>, ignored_titles array<string>, dropped_titles array<string>, "
    "prefix_labels boolean, diagnostic_run_ids array<string>, cleaning_flags array<string>"
)


def profile_rows() -> list[tuple]:
    return [
        (
            s, DISPLAY_NAMES[s], list(FIELD_ORDER.get(s, DEFAULT_ORDER)), list(IGNORED_TITLES.get(s, ())), list(DROPPED_TITLES.get(s, ())),
            s in PREFIX_LABELS, list(DIAGNOSTIC_RUNS.get(s, ())), [*BASE_FLAGS, *EXTRA_FLAGS.get(s, ())],
        )
        for s in SPIDER_ORDER
    ]


def with_profile(df: DataFrame) -> DataFrame:
    """Joins the profile of each row's ``spider``, or the default one.  The table has as many rows as there are literals above."""
    table = df.sparkSession.createDataFrame(profile_rows(), SCHEMA)
    strings = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    joined = df.join(F.broadcast(table), "spider", "left")
    return joined.withColumns(
        {
            "display_name": F.coalesce("display_name", F.initcap(F.replace("spider", F.lit("_"), F.lit(" ")))),
            "field_order": F.coalesce("field_order", strings(DEFAULT_ORDER)),
            "ignored_titles": F.coalesce("ignored_titles", strings(())),
            "dropped_titles": F.coalesce("dropped_titles", strings(())),
            "prefix_labels": F.coalesce("prefix_labels", F.lit(False)),
            "diagnostic_run_ids": F.coalesce("diagnostic_run_ids", strings(())),
            "cleaning_flags": F.coalesce("cleaning_flags", strings(BASE_FLAGS)),
        }
    )
