"""License scans with DataFrame functions only.

Overlapping windows of a text get MinHash values over their shingles; bands of these
retrieve license templates, and exact containment of a template's shingles in the window
verifies them.

*Windows.* Templates fall in size classes, powers of two of their word counts. Windows
are three class sizes long and move by one, so each place of a template lies whole in a
window together with what the template's own deviations add. Its similarity to a window that
holds 80 percent of its shingles follows from their counts: 0.05 for five words (one of a
window's 20), 0.09 for nine, 0.12 for 33. Each class has as many bands of one value each
as its least similar template needs to miss such a window with a probability of at most
``MISSED``: 180 for five words, 99 for nine.

*Cover words.* A window with 80 percent of a template's shingles misses fewer of them
than any set of over 20 percent has. For such a set of each template, words are chosen
by rule so that each shingle of the set has one. Texts and windows without any of these
words can't hold a template and go no further; nothing is lost by that.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only
from .license_texts import TEMPLATES

#: Words of a shingle, the least share of a template's shingles, the most probable miss of a window.
SIZE, CONTAINED, MISSED = 5, 0.8, 1e-4

SEED = 20011

#: Long words of licenses that other texts have as often.
COMMON = frozenset(("without", "including", "provided", "purpose", "following", "granted", "permission", "particular", "program", "public", "general"))


def words_of(text: str) -> list[str]:
    """The same words in Python, for templates and tests."""
    return re.findall(r"[a-z0-9]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text))


def shingles_of(words: list[str]) -> set[str]:
    size = min(SIZE, len(words))
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def cover_words(templates: dict[str, str], contained: float) -> list[str]:
    """Words one of which stands in every text that holds ``contained`` of a template's shingles.

    The longer word that helps most templates comes next, until the shingles with a
    chosen word are more than a text may miss. Words inside others count for these too.
    """
    open_ = {name: shingles_of(words_of(t)) for name, t in templates.items()}
    need = {name: int((1 - contained) * len(s) + 1e-9) + 1 for name, s in open_.items() if s}
    out: list[str] = []
    while need:
        counts = Counter(w for name in need for w in {w for s in open_[name] for w in s.split()})
        best = max(counts, key=lambda w: (len(w) >= 7 and w not in COMMON, counts[w], len(w), w))
        out.append(best)
        for name in list(need):
            covered = {s for s in open_[name] if best in s}
            open_[name] -= covered
            need[name] -= len(covered)
            if need[name] <= 0:
                del need[name]
    return out


def size_class(words: int) -> int:
    return max(SIZE + 3, 1 << (words - 1).bit_length())


def bands_for(template: str, contained: float) -> int:
    """Bands by which a full window with just ``contained`` of the template is missed at most once in 1 / ``MISSED``."""
    words = words_of(template)
    wanted, window = len(shingles_of(words)), 3 * size_class(len(words)) - SIZE + 1
    held = max(1, math.ceil(contained * wanted - 1e-9))
    similarity = held / (window + wanted - held)
    return math.ceil(math.log(MISSED) / math.log(1 - similarity))


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(low: Column) -> Column:
    return F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0))


def _shingles(words: Column, size: int = SIZE) -> Column:
    """Every ``SIZE``-word shingle; all words if there are fewer; none without words."""

    def made(w: Column) -> Column:
        n = F.least(F.lit(size), F.size(w))
        every = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(every))

    return F.transform(F.array(words), made)[0]  # the words are reckoned once


def _band_keys(shingles: Column, bands: Column) -> Column:
    """One key for each band: its number and the least of the shingles' hashes under its seed."""
    return F.transform(F.sequence(F.lit(1), bands), lambda b: F.xxhash64(b, F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, b * SEED)))))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, contained: float = CONTAINED, bands: int | None = None) -> DataFrame:
    """One row for each document and license found in it: doc_id, license, containment, first_word, places.

    A license is found if a window holds ``contained`` of its shingles: ``containment``
    is the most of any window, ``first_word`` the first window's first word (from 0),
    ``places`` the number of such windows. ``bands`` sets one number of bands for all size
    classes. Words are runs of a-z and 0-9 in lower case.
    Null and empty texts and null ids have no licenses; repeated rows count once; an
    empty table gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    needed: dict[int, int] = {}
    for t in templates.values():
        c = size_class(len(words_of(t)))
        needed[c] = max(needed.get(c, 1), bands or bands_for(t, contained))
    rows = [(name, c := size_class(len(words_of(t))), needed[c], sorted(shingles_of(words_of(t)))) for name, t in templates.items()]
    known = spark.createDataFrame(rows, "license string, class int, bands int, wanted array<string>")
    base = only(docs, doc_id="bigint", text="string").filter("doc_id is not null").select("doc_id", _lowered(F.col("text")).alias("low"))
    cover = cover_words(templates, contained)

    def covered(text: str) -> Column:
        hit = F.lit(False)
        for word in cover:
            hit = hit | F.contains(F.col(text), F.lit(word))
        return hit

    worded = base.filter(covered("low")).select("doc_id", _words(F.col("low")).alias("words")).filter(F.size("words") > 0)
    classes = F.array(*[F.lit(c) for c in sorted(needed)])
    bands_in = F.lit(0)
    for c, n in needed.items():
        bands_in = F.when(F.col("class") == c, n).otherwise(bands_in)
    sized = worded.select("doc_id", "words", F.explode(classes).alias("class"))
    # a text of n words has windows at 0, class, 2 * class, ... up to the first that reaches its end
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - 2 * F.col("class") - 1), F.col("class"))
    windows = sized.select("doc_id", "class", "words", F.explode(starts).alias("start"))
    windows = windows.select("doc_id", "class", "start", F.array_join(F.slice("words", F.col("start") + 1, 3 * F.col("class")), " ").alias("part")).filter(covered("part"))
    windows = windows.select("doc_id", "class", "start", _shingles(F.split("part", " ")).alias("shingles"))
    keyed = windows.select("doc_id", "class", "start", "shingles", F.explode(_band_keys(F.col("shingles"), bands_in)).alias("key"))
    bands_of = known.select("license", "class", "wanted", F.explode(_band_keys(F.col("wanted"), F.col("bands"))).alias("key"))
    # the templates are fixed, so their side has a proven bound
    candidates = keyed.join(F.broadcast(bands_of), ["class", "key"])
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    found = candidates.select("doc_id", "license", "start", share.alias("share")).filter(F.col("share") >= contained)
    return found.groupBy("doc_id", "license").agg(F.max("share").alias("containment"), F.min("start").cast("bigint").alias("first_word"), F.count_distinct("start").alias("places"))
