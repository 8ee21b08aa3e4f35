"""Text normalisation, identity keys and fuzzy ratios."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = "\u001f"
MBID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
TRACK_URI = r"^spotify:track:[A-Za-z0-9]{22}$"
EPISODE_URI = r"^spotify:episode:[A-Za-z0-9]{22}$"


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def normalized(c: Column) -> Column:
    """Lower-cased letters and digits, all else one space; null gives "". JVM-side; exact for
    text whose compatibility form and case folding are plain lower case (see ``normalized_exact``)."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def spaced(c: Column) -> Column:
    """Lower-cased with white space collapsed, punctuation kept."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), r"\s+", " ")), F.lit(""))


def _full(text: str) -> str:
    folded = unicodedata.normalize("NFKC", text).casefold()
    return " ".join(re.sub(r"[\W_]", " ", folded).split())


@F.pandas_udf(T.StringType())
def _normalize(s: pd.Series) -> pd.Series:
    return s.map(lambda text: None if text is None else _full(text))


@F.pandas_udf(T.StringType())
def _space(s: pd.Series) -> pd.Series:
    return s.map(lambda text: None if text is None else " ".join(unicodedata.normalize("NFKC", text).casefold().split()))


def _by_alphabet(c: Column, plain: Callable[[Column], Column], full: Callable[[Column], Column]) -> Column:
    """``plain`` for ASCII text, in the JVM; the others alone are sent to Python as text."""
    ascii_ = F.coalesce(c.rlike(r"^[\x00-\x7F]*$"), F.lit(True))
    return F.when(ascii_, plain(c)).otherwise(F.coalesce(full(F.when(~ascii_, c)), F.lit("")))


def normalized_exact(c: Column) -> Column:
    """``normalized`` by compatibility form (NFKC) and full case folding, for any alphabet."""
    return _by_alphabet(c, normalized, _normalize)


def spaced_exact(c: Column) -> Column:
    """``spaced`` by compatibility form (NFKC) and full case folding, for any alphabet."""
    return _by_alphabet(c, spaced, _space)


@F.pandas_udf(T.DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, in the order (query, candidate); it isn't symmetric."""
    return pd.Series([SequenceMatcher(None, x or "", y or "", autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.StringType())
def combined_lookup(artist: pd.Series, recording: pd.Series) -> pd.Series:
    """Artist and recording run together, without punctuation, in ASCII."""

    def made() -> Iterator[str]:
        for a, r in zip(artist, recording, strict=True):
            joined = re.sub(r"\W+", "", ((a or "") + (r or "")).lower())
            yield unicodedata.normalize("NFKD", joined).encode("ascii", "ignore").decode()

    return pd.Series(list(made()), dtype="object")


def track_uri(c: Column) -> Column:
    """A track URI from a URI, a bare 22-character id or a share link; else null."""
    value = F.trim(c)
    linked = F.regexp_extract(value, r"^https://(?:www\.)?open\.spotify\.com/track/([A-Za-z0-9]{22})(?:[?#].*)?/?$", 1)
    return F.when(value.rlike(TRACK_URI), value).when(value.rlike(r"^[A-Za-z0-9]{22}$"), F.concat(F.lit("spotify:track:"), value)).when(linked != "", F.concat(F.lit("spotify:track:"), linked))


def dump_provider(name: str) -> str:
    """The provider that a bulk dump's file name tells: its date and time, or else that it is local."""
    at = re.search(r"([0-9]{8})-([0-9]{6})", name.replace("\\", "/").rsplit("/", 1)[-1])
    return f"musicbrainz_canonical_dump_{at[1]}_{at[2]}" if at else "musicbrainz_canonical_dump_local"


def mbids(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({MBID})"), 1), F.lower)


def _folded(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def track_id(uri: Column, name: Column, artist: Column, album: Column) -> Column:
    digest = F.substring(F.sha2(F.concat_ws(UNIT, _folded(name), _folded(artist), _folded(album)), 256), 1, 24)
    return F.coalesce(uri, F.concat(F.lit("unresolved:track:"), digest))


def artist_key(artist: Column) -> Column:
    name = spaced(artist)
    return F.when(name != "", F.concat(F.lit("artist:"), F.substring(F.sha2(name, 256), 1, 24)))


def digest_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by the unit separator."""
    return F.sha2(F.concat_ws(UNIT, *parts), 256)


def platform_family(c: Column) -> Column:
    """The first family with a marker in the platform text; other text is ``other``."""
    # Fixed values, in order of precedence.
    families = (("ios", ("iphone", "ipad", "ios")), ("android", ("android",)), ("windows", ("windows",)), ("macos", ("macintosh", "macos", "os x")), ("linux", ("linux",)), ("web", ("browser", "web player", "web_player")), ("tv", ("television", "smart tv", "smart_tv")), ("game_console", ("playstation", "xbox", "game console")))
    low, out = F.lower(c), F.when(c.isNull(), F.lit(None).cast("string"))
    for family, markers in families:
        out = out.when(low.rlike("|".join(markers)), F.lit(family))
    return out.otherwise("other")


def escape_json_for_html(c: Column) -> Column:
    for raw, safe in (("&", "\\\\u0026"), ("<", "\\\\u003c"), (">", "\\\\u003e"), ("\u2028", "\\\\u2028"), ("\u2029", "\\\\u2029")):
        c = F.regexp_replace(c, raw, safe)
    return c


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def instant(text: Column) -> Column:
    """A timestamp from ISO text with an offset or Z; null without one or if it can't be parsed."""
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(F.regexp_replace(text, " ", "T")))
