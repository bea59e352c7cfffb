"""Rating arithmetic on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratinglens.labels import HOME_PLACE, PLACEHOLDERS, SPECIAL_PLACES, ZH, Labels


def participation(count: Column, votes: Column) -> Column:
    """count / votes, NULL unless there are votes."""
    return F.try_divide(count.cast("double"), F.when(votes > 0, votes).cast("double"))


def shrunk_score(score: Column, votes: Column, prior_mean: Column, prior_votes: Column) -> Column:
    """Vote-weighted pull of a score towards the overall mean."""
    total = votes.cast("double") + prior_votes
    return F.try_divide(votes.cast("double"), total) * score + F.try_divide(prior_votes, total) * prior_mean


def log_votes(votes: Column) -> Column:
    return F.log10(votes.cast("double") + 1)


def quadrant(score: Column, votes: Column, score_cut: Column, vote_cut: Column, labels: Labels = ZH) -> Column:
    """A value on the cut belongs to the upper side."""
    return F.concat_ws(
        "-",
        F.when(score >= score_cut, labels.high).otherwise(labels.low),
        F.when(votes >= vote_cut, labels.mass).otherwise(labels.niche),
    )


def origin_class(
    places: Column,
    home: str = HOME_PLACE,
    special: Sequence[str] = SPECIAL_PLACES,
    labels: Labels = ZH,
) -> Column:
    """Class of a set of distinct places; an empty or missing set is unknown."""
    inside = F.array(F.lit(home), *[F.lit(name) for name in special])
    known = F.filter(places, lambda p: ~F.lower(p).isin(*PLACEHOLDERS))
    local = F.size(F.array_intersect(known, inside)) > 0
    foreign = F.size(F.array_except(known, inside)) > 0
    at_home = F.array_contains(known, home)
    return (
        F.when(local & foreign, labels.coproduction)
        .when(at_home & (F.size(known) > 1), labels.coproduction)
        .when(at_home, labels.home)
        .when(local, labels.special)
        .when(foreign, labels.imported)
        .otherwise(labels.unknown)
    )


def wilson_bounds(successes: Column, total: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Lower and upper bound of a share; both NULL for an empty total."""
    n = F.when(total > 0, total).cast("double")
    p = successes / n
    scale = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / scale
    margin = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / scale
    return centre - margin, centre + margin


def entropy_bits(counts: Sequence[Column], total: Column) -> Column:
    """Base-2 entropy of a distribution given as class counts."""
    n = F.when(total > 0, total).cast("double")
    terms = [F.when(k > 0, -(k / n) * F.log2(k / n)).otherwise(F.lit(0.0)) for k in counts]
    return sum(terms[1:], terms[0]) + F.lit(0.0)


def flags_text(flags: Sequence[tuple[Column, str]], normal: str) -> Column:
    """Labels of the masks that hold, in the given order, joined with a semicolon."""
    joined = F.concat_ws(";", *[F.when(mask, label) for mask, label in flags])
    return F.when(joined == "", normal).otherwise(joined)
