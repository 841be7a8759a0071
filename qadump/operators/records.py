"""Dump lines to records.

A record is one `<row .../>` element on one line. Envelope lines are dropped.
Every other line either becomes a record or a reject with a reason; none is lost
in silence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from qadump.functions.values import beyond_bigint, instant, matches
from qadump.operators.row_xml import plain_attributes, plain_parts, row_attributes
from qadump.schemas import POSTS, QUESTION_POST_TYPE, USERS, Entity

PERMISSIVE = "permissive"
FAILFAST = "failfast"

_ROW_START = r"\A[ \t]*+<row[ \t/>]"


def _entity_checks(entity: Entity) -> list[tuple[str, str]]:
    """Reasons to reject a well-formed record, each with the condition that holds if it is bad."""
    checks = []
    if entity.name == POSTS.name:
        checks.append(("no_post_type", "PostTypeId is null"))
    if entity.name == USERS.name:
        checks += [
            ("bad_date", f"({name} is not null and {instant(name)} is null)")
            for name in ("CreationDate", "LastAccessDate")
        ]
    # Few texts are long enough to be looked at: one test for all keeps the generated code small.
    own = [
        f"if(PostTypeId = '{QUESTION_POST_TYPE}', {name}, null)" if name in entity.question_numbers else name
        for name in entity.numbers
    ]
    lengths = [f"length({name})" for name in entity.numbers]
    longest = f"greatest({', '.join(lengths)})" if len(lengths) > 1 else lengths[0]
    beyond = f"exists(array({', '.join(own)}), n -> coalesce({beyond_bigint('n')}, false))"
    checks.append(("bad_number", f"(coalesce({longest} > 18, false) and {beyond})"))
    return checks


def _reject_reason(entity: Entity) -> str:
    """SQL text: null for a good record, else why it is none. Good ones pass the first branch."""
    checks = _entity_checks(entity)
    good = " and ".join(["xml_error is null", *[f"not {bad}" for _, bad in checks]])
    return f"""case
        when {good} then null
        when line is null or not {matches("line", _ROW_START)} then 'not_a_row'
        when xml_error is not null then 'malformed'
        {" ".join(f"when {bad} then '{name}'" for name, bad in checks)}
        end"""


def parse(lines: DataFrame, entity: Entity) -> DataFrame:
    """Attributes as text (null if absent), with `line` and `reject_reason` (null for good rows).

    The parse runs in generators: filters on their output stay above them, so
    each line is parsed once. Only the entity's own attributes are extracted.
    """
    names = entity.attributes
    envelope = ", ".join(f"'{line}'" for line in entity.envelope)
    return (
        lines.selectExpr("value as line")
        .where(f"line is null or trim(line) not in ({envelope})")
        .selectExpr("line", f"explode(array({plain_parts('line')})) as parts")
        .selectExpr("line", f"explode(array({plain_attributes('line', 'parts', names, entity.numbers)})) as plain")
        .selectExpr(
            "line",
            f"inline({row_attributes('line', names, 'plain')}) as ({', '.join(names)}, xml_error)",
        )
        .selectExpr("line", *names, f"{_reject_reason(entity)} as reject_reason")
    )


# The counters of a pass: records and rejects
COUNTERS = (
    "count_if(reject_reason is null) as rows",
    "count_if(reject_reason is not null) as rejects",
)


def records(
    lines: DataFrame, entity: Entity, mode: str = PERMISSIVE, counted: Observation | None = None
) -> DataFrame:
    """Good records of a dump file, attributes as text.

    `permissive` leaves rejects out (see `rejects`), `failfast` fails the query at
    the first one.

    `counted` takes the counters `rows` and `rejects` from the pass that reads the records, without
    a second parse: `counted.get` has them after the first action over the result. They are
    those of the lines that this action read, so they are lower than those of `counters` where it stops
    early (a limit above, `first`, `isEmpty`), higher where it reads the lines more than once (two branches of a union,
    a stage that ran again after an executor was lost). The jobs count what they staged instead.
    """
    parsed = parse(lines, entity)
    if counted is not None:
        # What the filter below leaves out has been counted: it can't be pushed under the counters.
        parsed = parsed.observe(counted, *map(F.expr, COUNTERS))
    return checked(parsed, entity, mode).select(*entity.attributes)


def checked(parsed: DataFrame, entity: Entity, mode: str) -> DataFrame:
    """Good records of `parse`; in `failfast` mode a reject is an error."""
    if mode == PERMISSIVE:
        return parsed.where("reject_reason is null")
    if mode == FAILFAST:
        # a generator, so that no later filter can drop a faulty line before it is seen
        columns = ", ".join(parsed.columns)
        message = f"concat('{entity.file}: ', reject_reason, ': ', coalesce(line, 'null'))"
        record = f"if(reject_reason is null, array(struct({columns})), raise_error({message}))"
        return parsed.selectExpr(f"inline({record}) as ({columns})")
    raise ValueError(f"mode must be {PERMISSIVE!r} or {FAILFAST!r}, not {mode!r}")


def rejects_of(parsed: DataFrame, entity: Entity) -> DataFrame:
    return parsed.where("reject_reason is not null").selectExpr(
        f"'{entity.name}' as entity", "reject_reason", "line"
    )


def rejects(lines: DataFrame, entity: Entity) -> DataFrame:
    """Lines that are no record of the entity, whole, with the reason."""
    return rejects_of(parse(lines, entity), entity)


def counters(lines: DataFrame, entity: Entity) -> DataFrame:
    """One row: the entity's name, its number of good records and of rejects."""
    return (
        parse(lines, entity)
        .agg(*map(F.expr, COUNTERS))
        .selectExpr(f"'{entity.name}' as entity", "rows", "rejects")
    )
