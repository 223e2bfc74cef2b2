"""Column expressions over fragments, insertions and intervals."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellbulk import constants as C


def accession_of(file_name: Column) -> Column:
    """Text before the first dot of a file name."""
    return F.substring_index(file_name, ".", 1)


def shifted_start(start: Column) -> Column:
    return start + C.TN5_SHIFT


def shifted_end(end: Column) -> Column:
    return end - C.TN5_SHIFT


def insertion_sites(start: Column, end: Column) -> Column:
    """The two cut positions of a fragment, as an array."""
    return F.array(shifted_start(start), shifted_end(end) - 1)


def shifted_length(start: Column, end: Column) -> Column:
    return shifted_end(end) - shifted_start(start)


def is_nucleosome_free(start: Column, end: Column) -> Column:
    return shifted_length(start, end) < C.NUCLEOSOME_FREE_BELOW


def is_mono_nucleosomal(start: Column, end: Column) -> Column:
    length = shifted_length(start, end)
    return (length >= C.NUCLEOSOME_FREE_BELOW) & (length < C.MONO_NUCLEOSOME_BELOW)


def slice_of(position: Column, width: int) -> Column:
    """Index of the fixed-width genome slice a position lies in."""
    return F.floor(position / F.lit(width)).cast("long")


def has_prefix(text: Column, prefixes: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | text.startswith(prefix)
    return found


def pseudo_replicate(seed: int, *identity: Column) -> Column:
    """'1' or '2' with even odds, decided by a hash of the fragment itself."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in identity]))
    return F.when(F.substring(digest, 1, 1) < "8", "1").otherwise("2")
