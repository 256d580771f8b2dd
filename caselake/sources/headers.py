"""Matching a file's header with the columns that are wanted."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple


def words_of(name: str) -> str:
    """'Timely response?' -> 'timely_response': lower-case runs of ASCII letters and digits."""
    spaced = "".join(c if c.isascii() and c.isalnum() else " " for c in name.lower())
    return "_".join(spaced.split())


def run_together(name: str) -> str:
    """'Timely response?' -> 'timelyresponse'"""
    return words_of(name).replace("_", "")


class HeaderMatch(NamedTuple):
    found: dict[str, str]  # wanted column -> the file's name for it
    missing: list[str]
    extra: list[str]


def match_header(
    header: Sequence[str], wanted: Mapping[str, Sequence[str]], fold: Callable[[str], str]
) -> HeaderMatch:
    """Assign every name of ``header`` to the wanted column that lists its spelling.

    A column may list several spellings, best first; the best one present is taken and the others
    count as extra. Two names of one spelling are ambiguous and raise an error that shows them.
    """
    place = {fold(s): (column, rank) for column, spellings in wanted.items() for rank, s in enumerate(spellings)}
    candidates: dict[str, list[tuple[int, str]]] = {}
    extra = []
    for name in header:
        if fold(name) in place:
            column, rank = place[fold(name)]
            candidates.setdefault(column, []).append((rank, name))
        else:
            extra.append(name)
    found = {}
    for column, names in candidates.items():
        best = min(rank for rank, _ in names)
        chosen = [name for rank, name in names if rank == best]
        if len(chosen) > 1:
            raise ValueError(f"ambiguous header, {column} could be any of {chosen}")
        found[column] = chosen[0]
        extra += [name for rank, name in names if rank > best]
    return HeaderMatch(found, [c for c in wanted if c not in found], extra)
