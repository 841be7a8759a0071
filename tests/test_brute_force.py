"""The whole chain from dump lines, computed a second time in plain Python."""

import xml.etree.ElementTree as ET
from collections import Counter, defaultdict
from datetime import UTC, datetime, timedelta

import pytest

from compare import rows_of
from fixtures import render
from qadump.operators import counts, entities
from qadump.plans.master import user_master_from_dump
from qadump.schemas import (
    ANSWER_AVERAGES,
    ANSWER_TOTALS,
    BADGES,
    COMMENTS,
    ENTITIES,
    MASTER_COLUMNS,
    POST_HISTORY,
    POST_LINKS,
    POSTS,
    QUESTION_AVERAGES,
    QUESTION_TOTALS,
    USERS,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dump(spark):
    """Per entity the lines as a DataFrame, and the attributes of its records."""
    made = {}
    for entity in ENTITIES:
        lines = render.LINES[entity](spark, SF_DIR)
        texts = [row.value for row in lines.collect()]
        assert [t for t in texts if t in entity.envelope] == list(entity.envelope)
        made[entity] = lines, [ET.fromstring(t).attrib for t in texts if t not in entity.envelope]
    return made


def whole(text):
    """As an int column reads text; None is absent."""
    try:
        number = int(text) if text == text.strip() else None
    except ValueError:
        return None
    return number


def number(attributes, name):
    return whole(attributes.get(name, "0"))


def seconds(attributes, name):
    if name not in attributes:
        return 0
    moment = datetime.fromisoformat(attributes[name]).replace(tzinfo=UTC)
    return (moment - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(seconds=1)


def user_row(a):
    return {
        "id": number(a, "Id"),
        "reputation": number(a, "Reputation"),
        "signup_date": seconds(a, "CreationDate"),
        "last_access_date": seconds(a, "LastAccessDate"),
        "has_website": int(bool(a.get("WebsiteUrl"))),
        "has_location": int(bool(a.get("Location"))),
        "has_about_me": int(bool(a.get("AboutMe"))),
        "profile_views": number(a, "Views"),
        "up_votes": number(a, "UpVotes"),
        "down_votes": number(a, "DownVotes"),
        "age": number(a, "Age"),
    }


def post_row(a):
    accepted = number(a, "AcceptedAnswerId")
    return {
        "id": number(a, "Id"),
        "accepted_answer_id": accepted,
        "has_accepted_answer": None if accepted is None else int(accepted != 0),
        "score": number(a, "Score"),
        "views": number(a, "ViewCount"),
        "user_id": number(a, "OwnerUserId"),
        "answer_count": number(a, "AnswerCount"),
        "comment_count": number(a, "CommentCount"),
        "favourite_count": number(a, "FavoriteCount"),
        "body_length": len(a.get("Body", "")),
    }


def summary(posts, totals, count_name, averages):
    owners = defaultdict(list)
    for post in posts:
        owners[post["user_id"]].append(post)
    result = {}
    for owner, own in owners.items():
        row = {}
        for name, column in totals.items():
            values = [post[column] for post in own if post[column] is not None]
            row[name] = sum(values) if values else None
        row[count_name] = sum(post["id"] is not None for post in own)
        for name, total in averages.items():
            row[name] = row[total] / row[count_name]
        result[owner] = row
    return result


def key_counts(records, names):
    return Counter(tuple(whole(a.get(n, "")) for n in names) for a in records)


def as_rows(frame_columns, rows):
    return Counter(tuple(row.get(c) for c in sorted(frame_columns)) for row in rows)


def test_users(dump):
    lines, records = dump[USERS]
    found = entities.users(lines)
    assert rows_of(found) == as_rows(found.columns, map(user_row, records))


@pytest.mark.parametrize("kind", ["questions", "answers"])
def test_posts(dump, kind):
    lines, records = dump[POSTS]
    wanted = [a for a in records if (a["PostTypeId"] == "1") == (kind == "questions")]
    found = getattr(entities, kind)(lines)
    assert rows_of(found) == as_rows(found.columns, map(post_row, wanted))


@pytest.mark.parametrize(
    ("entity", "count"),
    [
        (BADGES, counts.badge_counts),
        (COMMENTS, counts.comment_counts),
        (POST_LINKS, counts.link_counts),
        (POST_HISTORY, counts.history_counts),
    ],
)
def test_counts(dump, entity, count):
    lines, records = dump[entity]
    found = Counter({tuple(row)[:-1]: tuple(row)[-1] for row in count(lines).collect()})
    assert found == key_counts(records, entity.attributes)


def test_user_master(dump):
    badges = key_counts(dump[BADGES][1], ["UserId"])
    comments = key_counts(dump[COMMENTS][1], ["UserId"])
    posts = [(a["PostTypeId"], post_row(a)) for a in dump[POSTS][1]]
    questions = summary(
        [p for t, p in posts if t == "1"], QUESTION_TOTALS, "total_questions", QUESTION_AVERAGES
    )
    answers = summary(
        [p for t, p in posts if t != "1"], ANSWER_TOTALS, "total_answers", ANSWER_AVERAGES
    )
    expected = []
    for user in map(user_row, dump[USERS][1]):
        key = user["id"]
        user["number_of_badges"] = badges.get((key,))
        user["number_of_comments"] = comments.get((key,))
        expected.append(user | answers.get(key, {}) | questions.get(key, {}))
    found = user_master_from_dump(*(dump[e][0] for e in (USERS, POSTS, BADGES, COMMENTS)))
    assert tuple(found.columns) == MASTER_COLUMNS
    assert rows_of(found) == as_rows(found.columns, expected)
