"""The whole language job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.operators.langid import decide as D
from crawlloom.operators.langid.dims import UNKNOWN
from crawlloom.operators.langid.hints import apply_priors
from crawlloom.operators.langid.model import LangModel
from crawlloom.operators.langid.score import chunk_language, lang_byte_totals, score_texts
from crawlloom.session import BROADCAST_ROWS, by_keys

DETAILS = ["text_bytes"] + [f"{n}{i}" for n in ("lang", "percent", "score") for i in (1, 2, 3)]


def text_chunks(
    df: DataFrame,
    model: LangModel,
    keys: Sequence[str],
    text: str = "text",
    colocated: bool = False,
    max_rows: int = BROADCAST_ROWS,
    priors: DataFrame | None = None,
) -> DataFrame:
    """Verdict per chunk of every text.

    ``priors`` (keys, lang, weight), as ``language_priors`` gives them, are added to
    the scores of every chunk of their text.

    The texts are shuffled once by ``keys``; every later aggregate groups by the
    keys and more columns and runs where the rows are. ``colocated=True`` says the
    input is bucketed or partitioned by the keys already.
    """
    texts = df.select(*keys, text)
    if not colocated:
        texts = by_keys(texts, keys)
    scores = score_texts(texts, model, keys, text, max_rows)
    if priors is not None:
        scores = apply_priors(scores, priors, keys)
    return chunk_language(scores, model.expected, keys)


def detect_language(
    df: DataFrame,
    model: LangModel,
    keys: Sequence[str],
    text: str = "text",
    details: bool = False,
    best_effort: bool = False,
    colocated: bool = False,
    priors: DataFrame | None = None,
) -> DataFrame:
    """(keys, lang, reliable) of every text that has letters; ``keys`` identify it."""
    chunks = text_chunks(df, model, keys, text, colocated, priors=priors)
    verdict = D.decide(lang_byte_totals(chunks, keys), keys, best_effort)
    return verdict.select(*keys, "lang", "reliable", *(DETAILS if details else []))


def with_language(df: DataFrame, verdict: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach verdicts; a text without letters is unknown and not reliable."""
    return df.join(verdict.select(*keys, "lang", "reliable"), list(keys), "left").withColumns(
        {
            "lang": F.coalesce("lang", F.lit(UNKNOWN)),
            "reliable": F.coalesce("reliable", F.lit(False)),
        }
    )
