"""Functions of running text: keys, declared stances, subjects."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import col, collapse_space, fold_accents


@F.pandas_udf(T.StringType())
def fold_unicode(s: pd.Series) -> pd.Series:
    """Lower case without any combining mark, for all scripts: what translate can't list."""

    def fold(t: str | None) -> str | None:
        return None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))

    return s.map(fold)


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """Named and numeric entities of a page resolved, once."""
    return s.map(lambda t: None if t is None else html.unescape(t))


@F.pandas_udf(T.StringType())
def ascii_only(s: pd.Series) -> pd.Series:
    """What is left of a text in ASCII after its characters are taken apart."""
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


@dataclass(frozen=True)
class StanceLexicon:
    """Patterns over folded text, a family each, and the confidences of the verdicts."""

    support_explicit: tuple[str, ...]
    oppose_explicit: tuple[str, ...]
    abstain_explicit: tuple[str, ...]
    support_declared_strong: tuple[str, ...]
    oppose_declared_strong: tuple[str, ...]
    support_declared_weak: tuple[str, ...]
    oppose_declared_weak: tuple[str, ...]
    negations: tuple[str, ...]
    explicit: float
    abstention: float
    strong: float
    weak: float


# The vote announcements and declarations that count, in Spanish and Catalan
# without accents, the negations right before them, and the confidence of each verdict.
_NOUNS = r"iniciativa(?:s)?|enmienda(?:s)?|proposicion(?:es)?|propuesta(?:s)?|proyecto(?:s)?|texto(?:s)?|ley(?:es)?|dictamen(?:es)?|medida(?:s)?|articulo(?:s)?|reforma(?:s)?"
SPANISH = StanceLexicon(
    support_explicit=(
        r"\bvotaremos\s+(a\s+)?favor\b",
        r"\bvotaremos(?:\s*,\s*\w+){0,4}\s*,?\s+(a\s+)?favor\b",
        r"\bvotare(mos)?\s+(que\s+)?si\b",
        r"\bvotara(mos|n)?\s+(a\s+)?favor\b",
        r"\b(vamos|voy|iremos)\s+a\s+votar\s+(a\s+)?favor\b",
        r"\b(vamos|voy|iremos)\s+a\s+votar\s+(que\s+)?si\b",
        r"\b(vamos|voy|iremos)\s+a\s+votar\s+(favorable|afirmativa|positiva)mente\b",
        r"\bvotaremos\s+favorablemente\b",
        r"\bvotamos\s+(a\s+)?favor\b",
        r"\bvotamos\s+favorablemente\b",
        r"\bhemos\s+votado\s+(a\s+)?favor\b",
        r"\bvotarem\s+(a\s+)?favor\b",
        r"\bvotarem\s+(que\s+)?si\b",
        r"\bvotarem\s+favorablement\b",
        r"\bnuestro\s+voto\s+sera\s+(favorable|positivo|afirmativo)\b",
        r"\bmi\s+voto\s+sera\s+(favorable|positivo|afirmativo)\b",
        r"\bnuestro\s+voto\s+sea\s+(favorable|positivo|afirmativo)\b",
        r"\bmi\s+voto\s+sea\s+(favorable|positivo|afirmativo)\b",
        r"\bvoto\s+(favorable|positivo|afirmativo)\b",
    ),
    oppose_explicit=(
        r"\bvotaremos\s+en\s+contra\b",
        r"\bvotaremos(?:\s*,\s*\w+){0,4}\s*,?\s+en\s+contra\b",
        r"\bvotare(mos)?\s+(que\s+)?no\b",
        r"\bvotara(mos|n)?\s+en\s+contra\b",
        r"\b(vamos|voy|iremos)\s+a\s+votar\s+en\s+contra\b",
        r"\b(vamos|voy|iremos)\s+a\s+votar\s+(que\s+)?no\b",
        r"\b(vamos|voy|iremos)\s+a\s+votar\s+negativamente\b",
        r"\bvotaremos\s+negativamente\b",
        r"\bvotamos\s+en\s+contra\b",
        r"\bvotamos\s+negativamente\b",
        r"\bhemos\s+votado\s+en\s+contra\b",
        r"\bno\s+votaremos\s+(a\s+)?favor\b",
        r"\bno\s+votaremos\s+en\s+absoluto\s+(a\s+)?favor\b",
        r"\bno\s+(vamos|voy|iremos)\s+a\s+votar\s+(a\s+)?favor\b",
        r"\bno\s+(vamos|voy|iremos)\s+a\s+votar\s+en\s+absoluto\s+(a\s+)?favor\b",
        r"\bno\s+(vamos|voy|iremos)\s+a\s+votar\s+favorablemente\b",
        r"\bvotarem\s+en\s+contra\b",
        r"\bvotarem\s+(que\s+)?no\b",
        r"\bvotarem\s+negativament\b",
        r"\bno\s+votarem\s+(a\s+)?favor\b",
        r"\bnuestro\s+voto\s+sera\s+(negativo|desfavorable)\b",
        r"\bmi\s+voto\s+sera\s+(negativo|desfavorable)\b",
        r"\bnuestro\s+voto\s+sea\s+(negativo|desfavorable)\b",
        r"\bmi\s+voto\s+sea\s+(negativo|desfavorable)\b",
        r"\bvoto\s+(negativo|desfavorable)\b",
    ),
    abstain_explicit=(
        r"\bnos\s+absten(dremos|emos)\b",
        r"\bme\s+abstendre\b",
        r"\bmi\s+voto\s+sera\s+abstencion\b",
        r"\babstencion\b",
        r"\babstencio\b",
        r"\babstener(nos|se)\b",
    ),
    support_declared_strong=(
        rf"\bapoy(?:amos|aremos)\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
        rf"\b(vamos|voy|iremos)\s+a\s+apoyar\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
        rf"\brespald(?:amos|aremos)\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
        rf"\bdefend(?:emos|eremos)\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
    ),
    oppose_declared_strong=(
        rf"\brechaz(?:amos|aremos)\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
        rf"\bnos\s+opon(?:emos|dremos)\s+(?:a\s+)?(?:\w+\s+){{0,6}}(?:{_NOUNS})\b",
        rf"\bno\s+apoy(?:amos|aremos)\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
        rf"\bno\s+(vamos|voy|iremos)\s+a\s+apoyar\b(?:\s+\w+){{0,8}}\s+\b(?:{_NOUNS})\b",
        r"\b(mantenemos|reafirmamos)\b(?:\s+\w+){0,6}\senmienda(?:s)?\s+a\s+la\s+totalidad\b",
    ),
    support_declared_weak=(
        r"\bapoyamos\b",
        r"\bapoyaremos\b",
        r"\b(vamos|voy|iremos)\s+a\s+apoyar\b",
        r"\brespaldamos\b",
        r"\bdefendemos\b",
        r"\bdefenderemos\b",
    ),
    oppose_declared_weak=(
        r"\brechazamos\b",
        r"\brechazaremos\b",
        r"\bnos\s+oponemos\b",
        r"\bnos\s+opondremos\b",
        r"\bno\s+apoyamos\b",
        r"\bno\s+apoyaremos\b",
        r"\bno\s+(vamos|voy|iremos)\s+a\s+apoyar\b",
    ),
    negations=("no", "nunca", "jamas"),
    explicit=0.74,
    abstention=0.68,
    strong=0.66,
    weak=0.58,
)


def declared_stance(text: Column | str, lexicon: StanceLexicon = SPANISH) -> Column:
    """struct(stance, polarity, confidence, reason) of a statement, null if it has none.

    A hit right after a negation doesn't count; a look-behind says so inside the pattern,
    so the test stays one expression a family. Announced votes go before abstentions,
    those before strong and weak declarations; signals of both kinds are mixed.
    """
    t = collapse_space(fold_accents(text))
    behind = "".join(rf"(?<!\b{n} )" for n in lexicon.negations)

    def said(family: tuple[str, ...]) -> Column:
        return t.rlike(f"(?U){behind}(?:{'|'.join(family)})")

    vote_for, vote_against, abstains = said(lexicon.support_explicit), said(lexicon.oppose_explicit), said(lexicon.abstain_explicit)
    strong_for, strong_against = said(lexicon.support_declared_strong), said(lexicon.oppose_declared_strong)
    weak_for, weak_against = said(lexicon.support_declared_weak), said(lexicon.oppose_declared_weak)
    any_for, any_against = strong_for | weak_for, strong_against | weak_against

    def verdict(stance: str, polarity: int, confidence: float, reason: str) -> Column:
        return F.struct(F.lit(stance).alias("stance"), F.lit(polarity).alias("polarity"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason"))

    mixed = verdict("mixed", 0, lexicon.weak, "conflicting_signal")
    return (
        F.when(abstains & (vote_for | vote_against | any_for | any_against), mixed)
        .when((vote_for & (vote_against | any_against)) | (vote_against & any_for), mixed)
        .when(vote_for, verdict("support", 1, lexicon.explicit, "explicit_vote_intent"))
        .when(vote_against, verdict("oppose", -1, lexicon.explicit, "explicit_vote_intent"))
        .when(abstains, verdict("mixed", 0, lexicon.abstention, "abstention_intent"))
        .when(strong_for & strong_against, mixed)
        .when(strong_for, verdict("support", 1, lexicon.strong, "declared_support"))
        .when(strong_against, verdict("oppose", -1, lexicon.strong, "declared_oppose"))
        .when(weak_for & weak_against, mixed)
        .when(weak_for, verdict("support", 1, lexicon.weak, "weak_declared_support"))
        .when(weak_against, verdict("oppose", -1, lexicon.weak, "weak_declared_oppose"))
    )


#: How a subject starts, words of a sentence that may be one, and titles
#: that are one by themselves.
SUBJECT_STARTS = ("proyecto", "proposici[oó]n", "moci[oó]n", "interpelaci[oó]n", "pregunta", "decreto-ley", r"real\s+decreto-ley", "tratado", "convenio", "acuerdo", "enmienda", "veto", "dictamen", "propuesta")
SUBJECT_WORDS = ("proyecto", "proposición", "proposicion", "moción", "mocion", "interpelación", "interpelacion", "pregunta", "decreto-ley", "acuerdo", "enmienda", "veto")
STRONG_TITLES = (
    r"proyecto\s+de\s+ley", r"proposici[oó]n\s+de\s+ley", r"ley\s+org[aá]nica", r"real\s+decreto-ley", "decreto-ley", "convenio", "tratado", "acuerdo",
    r"propuesta\s+de\s+reforma", r"proposici[oó]n\s+de\s+reforma", "moci[oó]n", "interpelaci[oó]n", "pregunta", "dictamen", "protocolo", "convenci[oó]n", "acta(?:s)?",
    "memor[aá]ndum", "memorando", "declaraci[oó]n(?:es)?", "resoluci[oó]n(?:es)?", "decisi[oó]n(?:es)?", "canje", "carta(?:s)?", r"texto\s+refundido", "estatuto(?:s)?", "instrumento",
    "denuncia", "retirada", "c[oó]digo", "anejo(?:s)?", "adenda", "adhesi[oó]n", "extensi[oó]n", "solicitud", "nota", "documento(?:s)?", "modificaci[oó]n(?:es)?",
)


def _clipped(c: Column, width: int) -> Column:
    return F.when(F.length(c) <= width, c).otherwise(F.concat(F.rtrim(F.substring(c, 1, width - 1)), F.lit("…")))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _holds_any(folded: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds the longest fixed piece of one of the patterns: where it does
    not, none of them can match."""
    pieces = sorted({max(re.split(r"\[[^]]*\]|\\s\+", w), key=len) for w in words})
    return reduce(lambda a, b: a | b, [F.contains(folded, F.lit(x)) for x in pieces])


def subject(text: Column | str, title: Column | str) -> Column:
    """struct(subject, confidence, method) of a document, by the first of: a window of 20 to
    320 characters from a keyword on (a strong title instead of one shorter than 40), the
    first sentence of 40 or more with a keyword, the title, the text's beginning. Without a
    text the title; without either an empty subject."""
    width = 320
    start = rf"(?iU)((?:{'|'.join(SUBJECT_STARTS)})[^.;:]{{20,{width}}})"
    has_word = lambda s: F.lower(s).rlike("|".join(SUBJECT_WORDS))
    out = lambda c, p, how: F.struct(c.alias("subject"), F.lit(p).alias("confidence"), F.lit(how).alias("method"))

    def first_window(t: Column) -> Column:
        # the pattern ignores case, so it takes these for i and s, which lower() does not
        folded = F.lower(reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), ("İi", "ıi", "ſs"), t))
        return F.when(_holds_any(folded, SUBJECT_STARTS), _once(collapse_space(F.regexp_extract(t, start, 1)), lambda w: _clipped(w, width))).otherwise("")

    def first_sentence(t: Column) -> Column:
        parts = F.transform(F.split(t, "[.;:!?]+"), lambda s: _clipped(F.trim(s), width))
        found = F.get(F.filter(parts, lambda s: (F.length(s) >= 40) & has_word(s)), F.lit(0))
        return F.when(_holds_any(F.lower(t), SUBJECT_WORDS), found)

    def chosen(t: Column, name: Column, window: Column, sentence: Column) -> Column:
        strong = (F.length(name) >= 35) & name.rlike(rf"(?iU)\b(?:{'|'.join(STRONG_TITLES)})\b")
        head = _clipped(name, width)
        return (
            F.when((t == "") & (name == ""), out(F.lit(""), 0.0, "empty"))
            .when((t == "") & strong, out(head, 0.74, "title_fallback_strong"))
            .when(t == "", out(head, 0.72, "title_fallback"))
            .when((window != "") & (F.length(window) < 40) & strong, out(head, 0.74, "title_hint_strong_from_short_window"))
            .when(window != "", out(window, 0.82, "keyword_window"))
            .when(sentence.isNotNull(), out(sentence, 0.76, "keyword_sentence"))
            .when((name != "") & strong, out(head, 0.74, "title_hint_strong"))
            .when(name != "", out(head, 0.68, "title_hint"))
            .otherwise(out(_clipped(t, 220), 0.56, "excerpt_fallback"))
        )

    name = F.coalesce(collapse_space(title), F.lit(""))
    whole = F.coalesce(collapse_space(text), F.lit(""))
    return _once(whole, lambda t: _once(first_window(t), lambda window: _once(F.when(window == "", first_sentence(t)), lambda sentence: chosen(t, name, window, sentence))))
