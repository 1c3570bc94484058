"""Rule mappings in the reference's configuration shape -> rule objects.

Takes already-parsed mappings (e.g. from ``yaml.safe_load``); nothing here
touches Spark. Three layouts are understood:

* relationships: ``{group: {"relationships": [{source_table, foreign_key,
  reference_table, reference_key, description}]}}``
* concept columns: ``{"...": {"tests": [{source_table, concept_field,
  description}]}}``
* patterns: ``{"...": {"tests": [{name, type, ...}]}}`` with ``type`` one of
  uniqueness, relationship, completeness, range_validation,
  referential_integrity, field_comparison, count_check.

Filters written with double-quoted identifiers (``"is_dummy" = FALSE``) are
rewritten to back-quoted ones, which is what they mean in the source
warehouse; literals and comments stay as they are. A bound ``YEAR(CURRENT_DATE())``
becomes the year of ``as_of``, and the current date and time of a count query become
``as_of`` too; they need it, so results are reproducible. A join condition may hold
equalities, terms on one side, one range between two columns (with intervals or numbers
added) and, beside an equality, anything else. ``count_check`` takes ``group_key``,
``counted`` and, for a join, ``joined`` and ``on`` keys, or the free SQL of the source format
(``count_query``), which becomes a ``QueryCount``: Spark runs it as it is, over the
loaded tables. One rule that can't be read does not lose the others:
``patterns_from_mapping`` gives it as an ``UnusableRule``, which a run reports as ERROR.
"""

from __future__ import annotations

import datetime as _dt
import re
from typing import Any, Dict, List, Mapping, Optional, Sequence, Tuple

from .functions.sqltext import Token, back_quoted, meaningful, qualifiers, requalified, split_at, tokens, written
from .rules import (
    CompletenessRule,
    ConceptColumn,
    FieldComparison,
    GroupCount,
    PatternRule,
    QueryCount,
    RangeCheck,
    ReferenceCheck,
    Relationship,
    RelationshipExists,
    RequiredFields,
    Uniqueness,
    UnusableRule,
    Within,
)

_CURRENT_YEAR = re.compile(r"^\s*year\s*\(\s*current_date\s*(\(\s*\))?\s*\)\s*$", re.I)

# Built-in completeness rules of the source configuration: table, column,
# minimum percent non-NULL (fixed values).
DEFAULT_COMPLETENESS_RULES = (
    CompletenessRule("PATIENT", "nhs_number_hash", 95.0),
    CompletenessRule("PATIENT", "birth_year", 98.0),
    CompletenessRule("PATIENT", "birth_month", 98.0),
    CompletenessRule("ENCOUNTER", "patient_id", 100.0),
    CompletenessRule("OBSERVATION", "patient_id", 100.0),
    CompletenessRule("PERSON", "id", 100.0),
)

# SQL type names of the rule format -> Spark cast targets (fixed values).
_CASTS = {"INTEGER": "int", "INT": "int", "BIGINT": "bigint", "FLOAT": "double", "DOUBLE": "double", "STRING": "string"}


def spark_filter(text: Optional[str]) -> Optional[str]:
    """Double-quoted identifiers -> back-quoted; None/blank stays None."""
    if text is None or not str(text).strip():
        return None
    return written(back_quoted(tokens(str(text))))


def spark_sql(text: str, as_of: Optional[_dt.date] = None) -> str:
    """A query of the source format for Spark: identifiers back-quoted, tables by their
    last name part (``"{source_db}"."SCHEMA"."T"`` is the loaded table ``T``), and the
    current date and time as of ``as_of``."""
    parts, out, k = tokens(text), [], 0
    while k < len(parts):
        five = parts[k : k + 5]
        if len(five) == 5 and all(t.kind == "quoted" for t in five[::2]) and all(t.says(".") for t in five[1::2]):
            out.append(five[4])
            k += 5
        elif parts[k].says("current_date", "current_timestamp", "localtimestamp") and not (k and parts[k - 1].says(".")):
            if as_of is None:
                raise ValueError(f"{parts[k].text} needs as_of, the date that the run is for")
            kind = "DATE" if parts[k].says("current_date") else "TIMESTAMP"
            out.append(Token("op", f"{kind} '{as_of}'"))
            k += 1
            call = [j for j in range(k, len(parts)) if parts[j].kind != "space"][:2]
            if len(call) == 2 and parts[call[0]].says("(") and parts[call[1]].says(")"):
                k = call[1] + 1
        else:
            out.append(parts[k])
            k += 1
    return written(back_quoted(out))


def _cast(value: Optional[str], default: Optional[str]) -> Optional[str]:
    if value is None:
        return default
    up = str(value).upper()
    if up not in _CASTS:
        raise ValueError(f"unsupported cast type {value!r}")
    return _CASTS[up]


def _bound(value: Any, as_of: Optional[_dt.date]):
    if isinstance(value, str) and _CURRENT_YEAR.match(value):
        if as_of is None:
            raise ValueError("a bound of the current year needs as_of, the date that the run is for")
        return as_of.year
    return value


def _base_side(base: str, joined: str, aliases: Tuple[str, str], item: Mapping[str, Any]) -> Optional[int]:
    """Which of two aliases is the base's: by the aliases given, the tables' names or
    their initials, else by the letters a name begins with. None if that doesn't tell."""
    low = [a.lower() for a in aliases]

    def exact(table: str, given: Any) -> Optional[int]:
        initials = "".join(w[0] for w in table.lower().split("_") if w)
        return next((low.index(n) for n in (str(given or "").lower(), table.lower(), initials) if n in low), None)

    def begins(table: str) -> Optional[int]:
        starts = [table.lower().startswith(a) for a in low]
        return starts.index(True) if sum(starts) == 1 else None

    for find in (exact, lambda table, _: begins(table)):
        at, other = find(base, item.get("base_alias")), find(joined, item.get("join_alias"))
        if at != other:
            return at if at is not None else 1 - other
    return None


_FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}


def _column(parts: Sequence[Token]) -> Optional[Tuple[str, str]]:
    """(alias, column) if the tokens are just that."""
    if len(parts) == 3 and parts[1].says(".") and parts[0].name and parts[2].name:
        return parts[0].name.lower(), parts[2].name
    return None


def _offset(parts: Sequence[Token]) -> Optional[Tuple[Tuple[str, str], Any]]:
    """``((alias, column), added)`` of ``alias.column``, with a number or an interval
    added or taken away, or of ``DATEADD(unit, n, alias.column)``."""
    plain = _column(parts)
    if plain:
        return plain, 0
    if len(parts) >= 10 and parts[0].says("dateadd") and parts[1].says("(") and parts[-1].says(")"):
        unit, _, *rest = parts[2:-1]
        sign = -1 if rest[0].says("-") else 1
        rest = rest[1:] if rest[0].says("-", "+") else rest
        at = _column(rest[2:])
        return (at, f"{sign * int(rest[0].text)} {unit.text}") if at and rest[0].kind == "number" and rest[1].says(",") else None
    at, more = _column(parts[:3]), list(parts[4:])
    if not at or len(parts) < 5 or not parts[3].says("+", "-"):
        return None
    sign = "-" if parts[3].says("-") else ""
    if len(more) == 1 and more[0].kind == "number":
        n = float(sign + more[0].text)
        return at, int(n) if n == int(n) and more[0].text.isdigit() else n
    if more[0].says("interval"):
        words = [t.text.strip("'").strip() for t in more[1:]]
        text = " ".join(words)
        if re.fullmatch(r"\d+ [A-Za-z]+", text):
            return at, f"{sign}{text}"
    return None


def _comparison(term: Sequence[Token]) -> Optional[List[Tuple[Any, str, Any]]]:
    """Sides and operators of a comparison of two columns, one of them possibly moved."""
    ops = [k for k, t in enumerate(term) if t.kind == "op" and t.text in ("=", *_FLIPPED)]
    if len(ops) == 1 and not any(t.says("between") for t in term):
        left, right = _offset(term[: ops[0]]), _offset(term[ops[0] + 1 :])
        return [(left, term[ops[0]].text, right)] if left and right else None
    at = [k for k, t in enumerate(term) if t.says("between")]
    if len(at) == 1 and not ops and not term[at[0] - 1].says("not"):
        to = [k for k, t in enumerate(term) if k > at[0] and t.says("and")]
        if len(to) == 1:
            x, low, high = _offset(term[: at[0]]), _offset(term[at[0] + 1 : to[0]]), _offset(term[to[0] + 1 :])
            return [(x, ">=", low), (x, "<=", high)] if x and low and high else None
    return None


def _negated(offset: Any) -> Any:
    if isinstance(offset, str):
        return offset[1:] if offset.startswith("-") else f"-{offset}"
    return -offset


def _join_rule(item: Mapping[str, Any]) -> Dict[str, Any]:
    """What a rule joins on: ``on``, ``within``, ``base_on``, ``joined_on`` and ``condition`` of a
    ``RelationshipExists``, from ``on`` pairs or a join condition.

    The condition is read as a whole or refused, never cut down. The base side is
    found by alias, whichever side of a comparison it is written on.
    """
    if item.get("on"):
        return {"on": tuple((str(a), str(b)) for a, b in item["on"])}
    cond = str(item.get("join_condition", ""))
    refuse = ValueError(f"cannot read join condition {cond!r}; give 'on' pairs")
    parts = meaningful(tokens(cond))
    aliases = qualifiers(parts)
    if len(aliases) != 2 or len(split_at(parts, "or")) > 1:
        raise refuse
    base, joined = item.get("base_table", item.get("table", "")), item.get("join_table", item.get("joined", ""))
    at = _base_side(base, joined, (aliases[0], aliases[1]), item)
    if at is None:
        raise ValueError(f"cannot tell the sides of {cond!r} apart; give 'on' pairs or 'base_alias'")
    own = aliases[at]
    pairs: List[Tuple[str, str]] = []
    ranges: Dict[Tuple[str, str], Dict[str, Any]] = {}
    sides: Dict[str, List[str]] = {"base_on": [], "joined_on": []}
    other: List[str] = []

    def as_condition(term):
        return requalified(term, lambda a: "b" if a == own else "j")

    for term in split_at(parts, "and"):
        names = qualifiers(term)
        if not names:
            raise refuse
        if len(names) == 1:
            sides["base_on" if names[0] == own else "joined_on"].append(f"({requalified(term, lambda a: None)})")
            continue
        found = _comparison(term)
        read = []
        for left, op, right in found or []:
            # As: joined column, operator, base column moved by an offset.
            if left[0][0] == own:
                left, op, right = right, _FLIPPED.get(op, op), left
            if left[0][0] == own or right[0][0] != own or (left[1] and right[1]):
                break
            move = right[1] if right[1] else _negated(left[1]) if left[1] else 0
            read.append((right[0][1], left[0][1], op, move))
        if not found or len(read) != len(found):
            other.append(f"({as_condition(term)})")
            continue
        for b, j, op, move in read:
            if op == "=" and not move:
                pairs.append((b, j))
                continue
            bounds = ranges.setdefault((b, j), {"terms": []})
            bounds["terms"].append(term)
            for side, ops in (("low", (">", ">=", "=")), ("high", ("<", "<=", "="))):
                if op in ops:
                    # Two bounds of one side are not compared here.
                    bounds["twice"] = bounds.get("twice") or side in bounds
                    bounds[side], bounds[f"{side}_open"] = move, op in ("<", ">")
    within = None
    for (b, j), bounds in ranges.items():
        terms = bounds.pop("terms")
        if within is None and not bounds.pop("twice", False):
            within = Within(b, j, **bounds)
        else:
            other += dict.fromkeys(f"({as_condition(t)})" for t in terms)
    if not pairs and (within is None or other):
        raise refuse
    return {
        "on": tuple(pairs), "within": within, "condition": " AND ".join(other) or None,
        **{k: " AND ".join(v) or None for k, v in sides.items()},
    }


def _on_pairs(item: Mapping[str, Any]) -> Tuple[Tuple[str, str], ...]:
    """Equality pairs ``(base_col, joined_col)``; a condition that holds more is refused."""
    read = _join_rule(item)
    if any(v for k, v in read.items() if k != "on"):
        raise ValueError(f"cannot read join condition {item.get('join_condition')!r}; give 'on' pairs")
    return read["on"]


def relationships_from_mapping(doc: Mapping[str, Any]) -> List[Relationship]:
    out: List[Relationship] = []
    for group, body in doc.items():
        if not isinstance(body, Mapping):
            continue
        for r in body.get("relationships", []) or []:
            out.append(
                Relationship(
                    child=r["source_table"],
                    fk=r.get("foreign_key", r.get("source_key", "id")),
                    parent=r["reference_table"],
                    key=r.get("reference_key", "id"),
                    group=group,
                    description=r.get("description"),
                    filter=spark_filter(r.get("filter")),
                )
            )
    return out


def completeness_from_mapping(doc: Mapping[str, Any]) -> List[CompletenessRule]:
    """``{"TABLE.column": min_pct}`` (or ``{"TABLE.column": {"min_completeness": x}}``)."""
    out: List[CompletenessRule] = []
    for key, val in doc.items():
        table, column = str(key).split(".", 1)
        pct = val.get("min_completeness") if isinstance(val, Mapping) else val
        out.append(CompletenessRule(table, column, float(pct)))
    return out


def concepts_from_mapping(doc: Mapping[str, Any]) -> List[ConceptColumn]:
    out: List[ConceptColumn] = []
    for body in doc.values():
        if not isinstance(body, Mapping):
            continue
        for t in body.get("tests", []) or []:
            out.append(ConceptColumn(t["source_table"], t["concept_field"], description=t.get("description")))
    return out


def pattern_from_item(item: Mapping[str, Any], as_of: Optional[_dt.date] = None) -> PatternRule:
    kind = item["type"]
    name = item["name"]
    desc = item.get("description", "")
    flt = spark_filter(item.get("filter"))
    if kind == "uniqueness":
        return Uniqueness(name, item["table"], item["unique_column"], count_nulls=bool(item.get("count_nulls", False)), filter=flt, description=desc)
    if kind == "relationship":
        if "source_key" in item and "reference_key" in item:
            return ReferenceCheck(name, item["base_table"], item["source_key"], item["join_table"], item["reference_key"], filter=flt, exclude_null_keys=True, mode="integrity", description=desc)
        return RelationshipExists(
            name, item["base_table"], item["join_table"], filter=flt, count=item.get("count", "entities"),
            entity=item.get("entity", "id"), description=desc, **_join_rule(item),
        )
    if kind == "completeness":
        return RequiredFields(name, item["table"], tuple(item["required_fields"]), filter=flt, check_empty=bool(item.get("check_empty_strings", False)), description=desc)
    if kind == "range_validation":
        return RangeCheck(
            name, item["table"], item["field"], _bound(item.get("min_value"), as_of), _bound(item.get("max_value"), as_of),
            cast_to=_cast(item.get("cast_to"), "int"), filter=flt,
            exclude_nulls=bool(item.get("exclude_nulls", True)), exclude_empty=bool(item.get("exclude_empty", True)), description=desc,
        )
    if kind == "referential_integrity":
        return ReferenceCheck(
            name, item["source_table"], item["source_key"], item["reference_table"], item.get("reference_key", "id"),
            filter=flt, exclude_null_keys=bool(item.get("exclude_null_keys", True)), mode=item.get("mode", "integrity"), description=desc,
        )
    if kind == "field_comparison":
        return FieldComparison(
            name, item["table"], item["field1"], item["field2"], item["comparison"], cast_to=_cast(item.get("cast_to"), "int"),
            filter=flt, exclude_empty=bool(item.get("exclude_empty", True)), description=desc,
        )
    if kind == "count_check":
        if item.get("count_query"):
            return QueryCount(name, item["table"], spark_sql(item["count_query"], as_of), filter=flt, description=desc)
        if "group_key" not in item or "counted" not in item:
            raise ValueError(f"count_check {name!r} needs 'count_query', or 'group_key' and 'counted'")
        return GroupCount(
            name, item["table"], item["group_key"], item["counted"], joined=item.get("joined"),
            on=_on_pairs(item) if item.get("joined") else (), join_filter=spark_filter(item.get("join_filter")),
            filter=flt, min_count=int(item.get("min_count", 1)), description=desc,
        )
    raise ValueError(f"unknown pattern type {kind!r}")


def patterns_from_mapping(doc: Mapping[str, Any], as_of: Optional[_dt.date] = None) -> List[PatternRule]:
    out: List[PatternRule] = []
    for body in doc.values():
        if not isinstance(body, Mapping):
            continue
        for k, item in enumerate(body.get("tests", []) or []):
            try:
                out.append(pattern_from_item(item, as_of))
            except (KeyError, ValueError) as e:
                out.append(UnusableRule(str(item.get("name") or f"rule {k}"), f"{type(e).__name__}: {e.args[0] if e.args else e}"))
    return out
