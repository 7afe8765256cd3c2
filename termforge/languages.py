"""Languages: how sentences end and which characters count as the script. ``register`` adds more."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Language:
    code: str
    sentence: str  # what ends a sentence
    script: str  # character class of the script, without brackets


# Sentence ends and scripts of the supported languages.
LANGUAGES: dict[str, Language] = {
    "ru": Language("ru", r"[.!?]+(?=\s+[A-ZА-Я]|$)", r"Ѐ-ӿ"),
    "en": Language("en", r"[.!?]+(?=\s+[A-Z]|$)", "a-zA-Z"),
    "he": Language("he", r"[.!?]+(?=\s+[֐-׿]|$)", r"֐-׿"),
}
DEFAULT = "ru"


def register(language: Language) -> None:
    LANGUAGES[language.code] = language


for _code, _upper, _letters in (("fr", "A-ZÀ-Ý", "a-zA-ZÀ-ÿœŒ"), ("de", "A-ZÄÖÜ", "a-zA-ZäöüÄÖÜß"), ("es", "A-ZÁÉÍÓÚÑÜ", "a-zA-ZáéíóúñüÁÉÍÓÚÑÜ")):
    register(Language(_code, rf"[.!?]+(?=\s+[{_upper}]|$)", _letters))


def language(code: str | None) -> Language:
    """The language of a code in any case; null or empty is the default, an unknown one an error."""
    code = (code or DEFAULT).lower()
    if code not in LANGUAGES:
        raise ValueError(f"unsupported language {code}")
    return LANGUAGES[code]
