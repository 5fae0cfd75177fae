"""Text rules as Column expressions; nothing here leaves the JVM.

``(?U)`` makes ``\\s``, ``\\w``, ``\\d`` and ``\\b`` follow Unicode, as the rules were defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens.functions.dictionary import replace_large

# Web addresses and the separator between joined comments.
URL = r"https?://\S+|www\.\S+"
COMMENT_SEPARATOR = "|||"

# Alternatives deleted by the heavy cleaner. Order matters, and the
# bare short words have no word bounds, so they also vanish from inside words.
HEAVY_ALTERNATIVES = [
    r"\b(https?://\S+|www\.\S+|helplinehttps\S*|\S*https?\S*)\b",
    r"\br/[a-zA-Z0-9_]+\b|\brptsd|\brbpd|\brselfhelp",
    r"please click list|findahelplinecomiiasp|sharing story bot|beyondblue",
    r"hi|anyone|etc|nonenglish|subreddit\S*|\breddit\w*",
    r"<[^>]*>",
    r"&\w+;",
    r"[@#]\S+",
    r"[\"“”‘’]",
    r"\b\d+\b",
    r"[^a-zA-Z0-9\s]",
]

# Domain words removed next to a general English stop list.
DOMAIN_STOP_WORDS = [
    "https", "http", "www", "helplinehttps", "nan", "deleted", "rselfhelp", "rbpd", "rptsd",
    "please click list", "findahelplinecomiiasp", "sharing story bot", "please remember subreddit",
    "mods keep positive", "beyondblue", "nonenglish",
    "frown", "andry", "pouting", "lapping", "face smiley", "happy face", "upsidedown", "upsidedown face",
    "hi", "anyone", "etc", "im", "dont", "like", "know", "ive", "ts", "wch", "get", "got",
    "na", "r", "feel", "time", "life", "want", "years", "really", "tnk",
    "gonna", "wanna", "gotta", "kinda", "sorta", "outta", "dunno", "lemme", "gimme",
    "whatcha", "betcha", "gotcha", "watcha", "coulda", "shoulda", "woulda", "hafta",
    "hasta", "lotsa",
]

# Emoticon words dropped together with :alias: names.
ALIAS_WORDS = ["frown", "andry", "pouting", "lapping", "smiley"]

# Common ASCII emoticons and emoji; callers pass larger tables of their own.
EMOTICONS = [
    (":-)", "happy face smiley"), (":)", "happy face smiley"), (":-(", "frown sad"), (":(", "frown sad"),
    (":-D", "laughing"), (":D", "laughing"), (";-)", "wink"), (";)", "wink"), (":'(", "crying"),
    (":-/", "skeptical"), (":-|", "straight face"), ("<3", "love"),
]
EMOJI = [
    ("😀", ":grinning_face:"), ("😂", ":face_with_tears_of_joy:"), ("🙂", ":slightly_smiling_face:"),
    ("😊", ":smiling_face_with_smiling_eyes:"), ("😢", ":crying_face:"), ("😭", ":loudly_crying_face:"),
    ("😡", ":enraged_face:"), ("😔", ":pensive_face:"), ("🙏", ":folded_hands:"), ("👍", ":thumbs_up:"),
    ("❤", ":red_heart:"), ("💔", ":broken_heart:"), ("🤗", ":smiling_face_with_open_hands:"),
]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """Whitespace words; the empty text has none."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def combined(title: Column, content: Column) -> Column:
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit(""))))


def light_clean(text: Column) -> Column:
    no_url = F.regexp_replace(text, "(?U)" + URL, " ")
    return collapse(F.replace(no_url, F.lit(COMMENT_SEPARATOR), F.lit(" ")))


def pair_table(pairs: Sequence[tuple[str, str]]) -> Column:
    """Ordered (key, value) pairs as one array literal."""
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in pairs])


def replace_in_order(text: Column, pairs: Sequence[tuple[str, str]], pad: bool = True) -> Column:
    """Apply literal replacements one after another; a fold keeps the plan small."""
    if not pairs:
        return text

    def put(t: Column, m: Column) -> Column:
        value = F.concat(F.lit(" "), m["v"], F.lit(" ")) if pad else m["v"]
        return F.replace(t, m["k"], value)

    return F.aggregate(pair_table(pairs), text, put)


# From so many pairs on a fold would read every text once per pair.
LARGE = 64


def replace_all(text: Column, pairs: Sequence[tuple[str, str]], pad: bool = True) -> Column:
    """Ordered replacements, by a fold or, for large dictionaries, by an automaton; the result is the same."""
    return (replace_large if len(pairs) >= LARGE else replace_in_order)(text, pairs, pad)


def emoticons_to_text(
    text: Column,
    dictionary: Sequence[tuple[str, str]],
    emoticons: Sequence[tuple[str, str]] = EMOTICONS,
    emoji: Sequence[tuple[str, str]] = EMOJI,
) -> Column:
    """Dictionary first, in its own order, then emoticons, then emoji names; trimmed, lower case."""
    out = replace_all(text, dictionary)
    out = replace_all(out, emoticons)
    return F.lower(strip(replace_all(out, emoji, pad=False)))


def emoticons_without_aliases(text: Column, dictionary: Sequence[tuple[str, str]], **tables) -> Column:
    """Variant that then deletes ``:alias:`` names and the alias words (emoji names go with them)."""
    out = replace_all(text, dictionary)
    out = replace_all(out, tables.get("emoticons", EMOTICONS))
    out = replace_all(out, tables.get("emoji", EMOJI), pad=False)
    out = F.regexp_replace(out, rf"(?iU)(:[^:]+:|_|\b({'|'.join(ALIAS_WORDS)})\b)", " ")
    return F.lower(strip(F.translate(out, ":_", "  ")))


def expand_contractions(text: Column) -> Column:
    """don't -> do not. Irregular forms first, then the regular endings."""
    rules = [
        ("’", "'"),
        (r"(?i)\b(w)on't\b", "$1ill not"),
        (r"(?i)\b(c)an't\b", "$1annot"),
        (r"(?i)\b(sh)an't\b", "$1all not"),
        (r"(?i)(\w)n't\b", "$1 not"),
        (r"(?i)\b(let)'s\b", "$1 us"),
        (r"(?i)\b(it|he|she|that|what|where|who|there|here|how|when|why)'s\b", "$1 is"),
        (r"(?i)\b(i)'m\b", "$1 am"),
        (r"(?i)(\w)'re\b", "$1 are"),
        (r"(?i)(\w)'ve\b", "$1 have"),
        (r"(?i)(\w)'ll\b", "$1 will"),
        (r"(?i)(\w)'d\b", "$1 would"),
    ]
    out = text
    for pattern, value in rules:
        out = F.regexp_replace(out, pattern, value)
    return F.when(text.rlike("['’]"), out).otherwise(text)


def heavy_clean(text: Column, word_bounds: bool = False, contractions: bool = True) -> Column:
    alternatives = list(HEAVY_ALTERNATIVES)
    if word_bounds:
        alternatives[3] = r"\b(?:hi|anyone|etc|nonenglish)\b|subreddit\S*|\breddit\w*"
    out = expand_contractions(text) if contractions else text
    out = collapse(out)
    return collapse(F.regexp_replace(out, "(?iU)" + "|".join(alternatives), ""))


def tokenize(text: Column, min_chars: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"([\p{{L}}\p{{N}}_]{{{min_chars},}})"), F.lit(1))


def string_set(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def remove_stop_words(tokens: Column, stop: Sequence[str]) -> Column:
    """Multi-word entries can never equal a token and so have no effect here."""
    return F.filter(tokens, lambda t: ~t.isin(list(stop))) if stop else tokens


def join_spaced_letters(text: Column) -> Column:
    """"p s y c h " -> "psych ", only when three spaced single letters occur somewhere.

    A letter joins the next one if a space follows that one; one pass reaches the end state.
    """
    joined = F.regexp_replace(text, r"(?U)\b(\w) (?=\w )", "$1")
    return F.when(text.rlike(r"(?U)\b(\w) (\w) (\w)"), joined).otherwise(text)


def flatten_lines(text: Column) -> Column:
    spaced = F.regexp_replace(join_spaced_letters(text), " +", " ")
    lines = F.transform(F.split(spaced, "\n"), strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def trim_to_sentence(text: Column, max_words: int = 100) -> Column:
    """Cut to the word limit, then back to the last sentence end, else the last late comma."""
    all_words = words(text)
    cut = F.array_join(F.slice(all_words, 1, max_words), " ")
    sentence = F.regexp_extract(cut, r"(?s)^(.+[.!?])", 1)
    clause = F.regexp_extract(cut, r"(?s)^(.*,)", 1)
    return (
        F.when(F.size(all_words) <= max_words, strip(text))
        .when(sentence != "", sentence)
        .when(F.length(clause) - 1 > F.length(cut) * 0.5, clause)
        .otherwise(cut)
    )


def token_estimate(text: Column) -> Column:
    return word_count(text) * F.lit(1.3) + F.lit(100.0)


def object_or_string(json: Column, field: str, key: str = "@value") -> Column:
    """``field`` may be an object holding ``key`` or a plain string; '' when absent."""
    inner = F.get_json_object(json, f"$.{field}['{key}']")
    plain = F.get_json_object(json, f"$.{field}")
    is_object = F.coalesce(plain, F.lit("")).startswith("{")
    return F.coalesce(F.when(is_object, inner).otherwise(plain), F.lit(""))


def labels_joined(json: Column, field: str, inner: str = "label", key: str = "@value") -> Column:
    """List of {label: object-or-string} objects as one '; '-joined text."""
    items = F.from_json(F.coalesce(F.get_json_object(json, f"$.{field}"), F.lit("[]")), "array<string>")
    return F.array_join(F.transform(items, lambda x: object_or_string(x, inner, key)), "; ")


# Openings that mark a line as instruction echo, and the fallback endings.
ECHO_OPENINGS = ["#", "Step", "Example", "For reference", "The", "To", "Output", "Preserve", "No", "Directly"]
FALLBACK_ENDINGS = ["", " coping strategies", " emotional support"]


def query_variants(query: Column, reply: Column, most: int = 5, least: int = 3) -> Column:
    """Usable lines of a model reply in line order; three fixed variants when too few remain."""
    lines = F.transform(F.split(reply, "\n"), strip)
    opening = "(?i)^(" + "|".join(ECHO_OPENINGS) + ")"
    good = F.filter(
        lines,
        lambda x: (word_count(x) > 2) & ~x.rlike(opening) & (F.lower(x) != F.lower(query)),
    )
    good = F.slice(F.array_distinct(good), 1, most)
    fallback = F.array(*[F.concat(query, F.lit(e)) for e in FALLBACK_ENDINGS])
    return F.when(F.size(good) < least, fallback).otherwise(good)


def hypothetical_document(reply: Column) -> Column:
    lines = F.filter(F.transform(F.split(reply, "\n"), strip), lambda x: x != "")
    return strip(F.replace(F.array_join(lines, " "), F.lit("Document:"), F.lit("")))


def usable_rewrite(query: Column, rewritten: Column) -> Column:
    """A rewrite of fewer than two words falls back to the query itself."""
    clean = strip(F.coalesce(rewritten, F.lit("")))
    return F.when(word_count(clean) < 2, query).otherwise(clean)


def first_number(text: Column, default: float = 5.0) -> Column:
    found = F.nullif(F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1), F.lit(""))
    return F.coalesce(found.try_cast("double"), F.lit(default))


def sentiment_bucket(score: Column) -> Column:
    return F.when(score > 0.05, "positive").when(score < -0.05, "negative").otherwise("neutral")


def label_slug(label: Column) -> Column:
    return F.lower(F.replace(label, F.lit(" "), F.lit("_")))


def entity_text(name: Column, description: Column, index_terms: Column) -> Column:
    """One null-safe definition of the searchable text of an entity."""
    parts = [F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit("")) for c in (name, description, index_terms)]
    return F.concat_ws(" ", *parts)


# Identifiers with a fixed shape, masked next to listed names.
IDENTIFIER_PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    r"https?://[^\s]+",
    r"\+?[0-9][0-9 ()-]{7,}[0-9]",
]


def mask_identifiers(text: Column, mask: str = "[PATIENT]") -> Column:
    out = F.coalesce(text, F.lit(""))
    for pattern in IDENTIFIER_PATTERNS:
        out = F.regexp_replace(out, pattern, mask)
    return out
