"""Language detection for the prefilter where there are no labelled texts to make profiles of (:mod:`profiles`): common words
and letters vote; six languages are known, the rest is ``other``."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SUPPORTED_LANGUAGES

# Frequent words and endings by language.
WORDS = {
    "en": "the of and to in is that it for was on are with as be this by from or an at which",
    "it": "il lo la gli le di che è un una per con non sono del della nel alla come anche più",
    "es": "el la los las de que y en un una por con no para del se su al como más es",
    "de": "der die das und in den von zu mit ist des dem nicht ein eine auf für sich im als auch",
    "fr": "le la les de des et en un une du que est dans pour au qui par sur pas avec ce",
    "pt": "o os as de que e do da em um uma para com não por mais dos das se na no",
}
ENDINGS = {"en": ("ing", "tion", "ed", "ly"), "it": ("zione", "mente", "are", "ità"), "es": ("ción", "mente", "ado", "dad"), "de": ("ung", "keit", "lich", "heit"), "fr": ("tion", "ment", "eux", "aux"), "pt": ("ção", "mente", "dade", "ões")}
LETTERS = {"en": "", "it": "ìòùàè", "es": "ñóíáú", "de": "äöüß", "fr": "êçèéœ", "pt": "ãõçâ"}
#: The same of languages that are not supported; a text that is closer to one of these is ``other``.
OTHERS = {
    "nl": "de het een en van ik te dat die in is niet op met voor zijn er aan ook wij naar om wordt bij",
    "sv": "och att det i en som på är av för med till den har inte om ett vi du från",
    "da": "og at det i en som på er af for med til den har ikke om et vi du fra",
    "pl": "i w na z do nie że się jest to o jak po dla od za przez są oraz który",
    "cs": "a v na se je že s z do o k i za pro ale jako po jsou nebo který",
    "ro": "și de la în a cu pe nu să este din care un o pentru ce mai sau sunt",
    "tr": "ve bir bu için ile da olarak çok daha en gibi ne var olan veya",
    "fi": "ja on ei että se oli hän mutta ovat kun niin myös joka tai sekä",
    "hu": "a az és hogy nem egy is van ez meg de csak mint volt vagy",
}
SETS = {k: frozenset(v.split()) for k, v in WORDS.items()}
OTHER_SETS = {k: frozenset(v.split()) for k, v in OTHERS.items()}


def detect(text: str | None) -> tuple[str, float]:
    low = (text or "").lower()
    words = re.findall(r"[^\W\d_]+", low)
    if not words or sum(c.isascii() or c in "".join(LETTERS.values()) for w in words for c in w) < 0.7 * sum(map(len, words)):
        return "other", 0.0
    votes = {k: sum(w in SETS[k] for w in words) + 0.5 * sum(w.endswith(ENDINGS[k]) for w in words) + 0.5 * sum(low.count(c) for c in LETTERS[k]) for k in SETS}
    best, total = max(votes, key=votes.get), sum(votes.values())
    foreign = max(sum(w in s for w in words) for s in OTHER_SETS.values())
    return (best, round(votes[best] / total, 4)) if total and foreign <= votes[best] else ("other", 0.0)


@F.pandas_udf(T.StructType().add("lang", "string").add("confidence", "double"))
def _detect(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([("other", 0.0) if x is None else detect(x) for x in s], columns=["lang", "confidence"])


def detect_language(c: Column, chars: int = 2000) -> Column:
    """Struct of ``lang`` and ``confidence`` from the first characters of a text."""
    return _detect(F.substring(c, 1, chars))


def supported(declared: Column, description: Column, detect: Callable[[Column], Column] | None = None) -> Column:
    """A declared language that is known is trusted; only other rows are detected: by ``detect``, which gives a struct with ``lang``
    (such as that of :mod:`profiles`), or without one by words."""
    trusted = F.coalesce(F.lower(declared).isin(*SUPPORTED_LANGUAGES), F.lit(False))
    return trusted | F.coalesce((detect or detect_language)(F.when(~trusted, description))["lang"].isin(*SUPPORTED_LANGUAGES), F.lit(False))
