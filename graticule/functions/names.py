"""Dataset names: parse paths by pattern, build names from facets, small string rules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_FIELD = re.compile(r"\{(\??)(\w+)\}")


def _pattern_to_regex(pattern: str) -> tuple[str, list[tuple[str, int]]]:
    """``{a}_{?b}.zarr`` -> a regular expression and its (field, group) list; a field marked ``?`` is matched but not kept.

    A field holds no ``_`` or ``/``; other text stands for itself.
    """
    out, fields, pos = "", [], 0
    for group, m in enumerate(_FIELD.finditer(pattern), start=1):
        out += re.escape(pattern[pos:m.start()]) + "([^_/]+)"
        if not m.group(1):
            fields.append((m.group(2), group))
        pos = m.end()
    return r"(?:^|/)" + out + re.escape(pattern[pos:]) + "$", fields


def parse_path(path: Column, patterns: Sequence[str]) -> dict[str, Column]:
    """One column per field of any pattern, taken from the first pattern that matches; NULL where it lacks the field."""
    compiled = [_pattern_to_regex(p) for p in patterns]
    names = list(dict.fromkeys(name for _, fields in compiled for name, _ in fields))
    out = {}
    for name in names:
        branch = None
        for regex, fields in compiled:
            group = dict(fields).get(name)
            value = F.regexp_extract(path, regex, group) if group else F.lit(None).cast("string")
            hit = path.rlike(regex)
            branch = F.when(hit, value) if branch is None else branch.when(hit, value)
        out[name] = branch
    return out


def format_path(template: str, facets: dict[str, Column] | Sequence[str]) -> Column:
    """Fill ``{facet}`` places of a template; NULL if a facet is NULL."""
    cols = facets if isinstance(facets, dict) else {f: F.col(f) for f in facets}
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(cols[m.group(2)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def split_member_id(member: Column) -> dict[str, Column]:
    """``<driving inst>_<driving model>_<inst>_<source>_<scenario>`` -> its parts, and the id without the scenario."""
    parts = F.split(member, "_")
    n = F.size(parts)
    return {
        "simulation": F.array_join(F.slice(parts, F.lit(1), n - 1), "_"),
        "experiment": F.element_at(parts, -1),
        "driving_institution": F.get(parts, F.lit(0)),
        "driving_model": F.get(parts, F.lit(1)),
        "institution": F.get(parts, F.lit(2)),
        "source": F.get(parts, F.lit(3)),
    }


def catalog_frequency(freq: Column) -> Column:
    """Frequencies as the catalog spells them: ``YS`` is stored as ``AS-JAN``."""
    return F.regexp_replace(freq, "YS", "AS-JAN")


def attribute_key(key: Column) -> Column:
    """``cat/source`` -> ``cat:source``."""
    return F.translate(key, "/", ":")


def title_of(name: Column) -> Column:
    """``pr_wet_freq`` -> ``Pr wet freq``."""
    spaced = F.translate(name, "_", " ")
    return F.concat(F.upper(F.left(spaced, F.lit(1))), F.lower(F.right(spaced, F.length(spaced) - 1)))
