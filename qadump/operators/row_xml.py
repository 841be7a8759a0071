r"""SQL text that reads one dump line as one XML `row` element.

Common lines go through `from_xml`. It has its limits, which are met as follows:

| `from_xml`                                              | here                         |
| ------------------------------------------------------- | ---------------------------- |
| takes any element name, ignores what follows an element | the line must have the shape |
| mixes up attribute names that differ by case only       | such lines are taken apart   |
| gives up on values of more than 524288 characters       | longer lines are taken apart |
| gives up on more than 1000 attributes                   | such lines are taken apart   |

To take a line apart means to cut it into attributes by pattern and to decode the
values in pieces. It gives the same result as `from_xml`, but takes longer.

Content between the tags of an element (dumps have none) is no part of a record. It is cut
off before either way is chosen, so a line is read by its start tag whatever its size; the
content is parsed by itself, and a fault there makes the line malformed.

Most lines of a dump need no XML parser, which is the dearest step of a pass: in a plain line one
pattern shows all there is, ASCII text between double quotes with none but the usual references. Such a
line is split at its quotes (`plain_parts`); any other goes on to `from_xml`.
"""

from __future__ import annotations

from qadump.functions.values import matches

LONG_LINE = 500_000
MANY_ATTRIBUTES = 1_000
# the shortest line that can hold that many attributes of different names
MANY_ATTRIBUTES_LINE = 5_000
PIECE = 400_000

# What a plain line's values may refer to, in the order of decoding: `&amp;` last, as it makes new `&`s.
_REFERENCES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#xA;", "\n"),
    ("&#xD;", "\r"),
    ("&#x9;", "\t"),
    ("&amp;", "&"),
)
# Printable ASCII without `"`, `&` and `<`, each by itself: the JVM looks them up in a table, but tries ranges in turn.
_PLAIN_CHARACTERS = "".join(rf"\x{code:02x}" for code in range(32, 127) if chr(code) not in '"&<')
_PLAIN_TEXT = f"[{_PLAIN_CHARACTERS}]*+"
# `xml` starts names with a meaning, `error` is `from_xml`'s own, and no value may look like a name between two.
_PLAIN = (
    r"\A[ \t]*+<row(?: (?!(?i:xml|error=))[A-Za-z]++=\x22(?! [A-Za-z]++=\x22)"
    rf"{_PLAIN_TEXT}(?:&(?:lt|gt|quot|#x[9AD]|amp);{_PLAIN_TEXT})*+\x22)*+ ?/>\z"
)

_XML_OPTIONS = (
    "map('ignoreSurroundingSpaces', 'false', 'attributePrefix', '@', "
    "'columnNameOfCorruptRecord', '@error')"
)


def _shape(known: tuple[str, ...] = ()) -> str:
    r"""Pattern for a line with one `row` element and nothing else.

    With `known` names, no attribute may differ from one of them by case only. The
    loop over attributes is possessive and no character can both continue and end
    a part, so the time is linear and the stack flat on lines of any length. `\x27`
    is the single quote.
    """
    return rf"{_start_tag(known)}/>[ \t]*\z"


def _start_tag(known: tuple[str, ...] = ()) -> str:
    name = r"(?!xmlns)(?:xml:)?[^ \t=<>\x22\x27/:]+"
    if known:
        names = "|".join(known)
        name = rf"(?:(?:{names})(?=[ \t]*=)|(?!(?i:{names})[ \t]*=){name})"
    value = r"(?:\x22[^\x22<]*\x22|\x27[^\x27<]*\x27)"
    return rf"(?s)\A[ \t]*<row(?:[ \t]+{name}[ \t]*=[ \t]*{value})*+[ \t]*"


# Content that ends with the element's only end tag, and what comes before that tag.
_CONTENT = r"(?s)\A>(?:(?!</row).)*+</row[ \t]*+>[ \t]*+\z"
_END_TAG = r"</row[ \t]*+>[ \t]*+\z"


def _from_xml(xml: str, attributes: tuple[str, ...]) -> str:
    fields = ", ".join(f"`@{name}` string" for name in attributes)
    return f"from_xml({xml}, '{fields}', {_XML_OPTIONS})"


def _taken_apart(line: str, attributes: tuple[str, ...]) -> str:
    """An array of one struct, as `from_xml` gives it for a line without content.

    Pieces end between character references, and each is decoded as an attribute
    of its own. One that cannot be decoded makes its whole value null, and the
    record an error; so do names that are invalid or not distinct.
    """
    attribute = (
        r"(?:\A[ \t]*+<row|\G)[ \t]++([^ \t=<>\x22\x27/]++)"
        r"[ \t]*+=[ \t]*+(\x22[^\x22]*+\x22|\x27[^\x27]*+\x27)"
    )
    names, quoted = (f"regexp_extract_all({line}, r'{attribute}', {group})" for group in (1, 2))
    pieces = (
        f"regexp_extract_all(substr(q, 2, length(q) - 2), r'(?:[^&]|&[^;&]*+;?){{1,{PIECE}}}+', 0)"
    )
    decoded = _from_xml("concat('<v a=', left(q, 1), piece, left(q, 1), '/>')", ("a",))
    value = (
        f"reduce(transform({pieces}, piece -> {decoded}.`@a`), '', "
        "(text, piece) -> concat(text, piece))"
    )
    name_error = _from_xml("concat('<v ', name, '=\"\"/>')", ("error",))
    faulty = (
        "size(array_distinct(r.names)) < size(r.names) "
        f"or exists(r.names, name -> {name_error}.`@error` is not null) "
        "or exists(r.texts, text -> text is null)"
    )
    fields = [f"get(r.texts, int(array_position(r.names, '{n}')) - 1) as `@{n}`" for n in attributes]
    record = f"struct({', '.join(fields)}, if({faulty}, 'malformed', null) as `@error`)"
    parts = f"struct({names} as names, transform({quoted}, q -> {value}) as texts)"
    return f"transform(array({parts}), r -> {record})"


def plain_parts(line: str) -> str:
    """What lies between the quotes of a plain line: ` Id=`, value, ` Score=`, value, ` />`; else null."""
    return (
        f"case when octet_length({line}) <= {LONG_LINE} and {matches(line, _PLAIN)} "
        f"then split(substr({line}, instr({line}, '<row') + 4), '\"') end"
    )


def plain_attributes(
    line: str, parts: str, attributes: tuple[str, ...], numbers: tuple[str, ...]
) -> str:
    """A struct as `from_xml` gives it, of a column of `plain_parts`; null for a line to be left to `from_xml`."""
    values = {n: f"get({parts}, int(nullif(array_position({parts}, ' {n}='), 0)))" for n in attributes}
    # Texts are decoded; no reference of a plain line makes a number, so that ones in numbers are left.
    fields = [
        f"{value if name in numbers else _decoded(value)} as `@{name}`" for name, value in values.items()
    ]
    in_texts = f"not contains(concat_ws('', {', '.join(values[n] for n in numbers)}), '&')"
    # A name that occurs twice is an error. If no two parts are equal, none does; else the names are looked at.
    names = rf"regexp_extract_all({line}, r' ([A-Za-z]++)=\x22', 1)"
    return (
        f"case when {parts} is not null and (not contains({line}, '&') or {in_texts}) "
        f"and (size(array_distinct({parts})) = size({parts}) "
        f"or size(array_distinct({names})) = size({parts}) div 2) "
        f"then struct({', '.join(fields)}, string(null) as `@error`) end"
    )


def _decoded(value: str) -> str:
    for reference, character in _REFERENCES:
        value = f"replace({value}, '{reference}', '{character}')"
    return value


def row_attributes(line: str, attributes: tuple[str, ...], plain: str) -> str:
    """An array of one struct: the attributes (null if absent), and the error (null if none).

    `plain` is a column of `plain_attributes`.
    """
    return f"if({plain} is not null, array({plain}), {_by_xml(line, attributes)})"


def _by_xml(line: str, attributes: tuple[str, ...]) -> str:
    """The same for lines of any kind, plain ones included."""
    nothing = ", ".join(f"string(null) as `@{name}`" for name in attributes)
    malformed = f"array(struct({nothing}, 'malformed' as `@error`))"
    # most lines pass the first test, which is a comparison of two bytes
    no_content = f"(endswith({line}, '/>') or {matches(line, r'/>[ \t]*+\z')})"
    # Lines without content go on as they are; of others the start tag, if the content is good.
    tag = f"regexp_extract({line}, r'{_start_tag()}', 0)"
    rest = f"substr({line}, length({tag}) + 1)"
    inner = f"regexp_replace(substr({rest}, 2), r'{_END_TAG}', '')"
    fault = _from_xml(f"concat('<row>', {inner}, '</row>')", ("error",))
    cut = f"case when {matches(rest, _CONTENT)} and {fault}.`@error` is null then concat({tag}, '/>') end"
    parsed = _of_start_tag("t", attributes, malformed)
    return (
        f"if({no_content}, {_of_start_tag(line, attributes, malformed)}, "
        f"transform(array({cut}), t -> get({parsed}, 0)))"
    )


def _of_start_tag(line: str, attributes: tuple[str, ...], malformed: str) -> str:
    common = f"array({_from_xml(line, (*attributes, 'error'))})"
    big = (
        f"(octet_length({line}) > {LONG_LINE} or (octet_length({line}) > {MANY_ATTRIBUTES_LINE}"
        f" and octet_length({line}) - octet_length(replace({line}, '=', '')) > {MANY_ATTRIBUTES}))"
    )
    has_shape = matches(line, _shape())
    in_known_case = matches(line, _shape(attributes))
    return f"""case
        when {in_known_case} and not {big} then {common}
        when {has_shape} then {_taken_apart(line, attributes)}
        else {malformed} end"""
