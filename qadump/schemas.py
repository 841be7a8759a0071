"""Names and types of the dump files and of the tables made from them."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Entity:
    """One dump file: its root tag and the record attributes that are read."""

    name: str
    file: str
    attributes: tuple[str, ...]
    #: attributes that hold integers
    numbers: tuple[str, ...]
    #: those of `numbers` that only questions have
    question_numbers: tuple[str, ...] = ()

    def narrowed(self, *left_out: str) -> Entity:
        """The same file, read without some attributes."""
        kept, numbers, own = (
            tuple(a for a in names if a not in left_out)
            for names in (self.attributes, self.numbers, self.question_numbers)
        )
        return replace(self, attributes=kept, numbers=numbers, question_numbers=own)

    @property
    def envelope(self) -> tuple[str, ...]:
        return (XML_DECLARATION, f"<{self.name}>", f"</{self.name}>")


# Envelope lines, attribute names and column names of the dump
# format and of the result tables.
XML_DECLARATION = '<?xml version="1.0" encoding="utf-8"?>'

USERS = Entity(
    "users",
    "Users.xml",
    (
        "Id", "Reputation", "CreationDate", "LastAccessDate", "WebsiteUrl", "Location",
        "AboutMe", "Views", "UpVotes", "DownVotes", "Age",
    ),
    ("Id", "Reputation", "Views", "UpVotes", "DownVotes", "Age"),
)
POSTS = Entity(
    "posts",
    "Posts.xml",
    (
        "Id", "PostTypeId", "AcceptedAnswerId", "Score", "ViewCount", "OwnerUserId",
        "AnswerCount", "CommentCount", "FavoriteCount", "Body",
    ),
    (
        "Id", "AcceptedAnswerId", "Score", "ViewCount", "OwnerUserId", "AnswerCount",
        "CommentCount", "FavoriteCount",
    ),
    ("AcceptedAnswerId", "AnswerCount"),
)
BADGES = Entity("badges", "Badges.xml", ("UserId",), ("UserId",))
COMMENTS = Entity("comments", "Comments.xml", ("UserId",), ("UserId",))
POST_LINKS = Entity("postlinks", "PostLinks.xml", ("PostId",), ("PostId",))
POST_HISTORY = Entity("posthistory", "PostHistory.xml", ("UserId", "PostId"), ("UserId", "PostId"))

ENTITIES = (USERS, POSTS, BADGES, COMMENTS, POST_LINKS, POST_HISTORY)

QUESTION_POST_TYPE = "1"

USER_COLUMNS = (
    "id", "reputation", "signup_date", "last_access_date", "has_website", "has_location",
    "has_about_me", "profile_views", "up_votes", "down_votes", "age",
)
QUESTION_COLUMNS = (
    "id", "accepted_answer_id", "score", "views", "user_id", "answer_count",
    "comment_count", "favourite_count", "body_length",
)
ANSWER_COLUMNS = (
    "id", "score", "views", "user_id", "comment_count", "favourite_count", "body_length",
)

# total -> the post column it sums
ANSWER_TOTALS = {
    "total_answer_score": "score",
    "total_answer_views": "views",
    "total_answer_comments": "comment_count",
    "total_answer_favourites": "favourite_count",
    "total_answer_body_length": "body_length",
}
QUESTION_TOTALS = {
    "total_question_score": "score",
    "total_question_views": "views",
    "total_question_answers": "answer_count",
    "total_question_accepted_answers": "has_accepted_answer",
    "total_question_comments": "comment_count",
    "total_question_favourites": "favourite_count",
    "total_question_body_length": "body_length",
}
ANSWER_COUNT = "total_answers"
QUESTION_COUNT = "total_questions"

# average -> the total it divides by the post count
ANSWER_AVERAGES = {
    "average_answer_score": "total_answer_score",
    "average_answer_body_length": "total_answer_body_length",
    "average_answer_comments": "total_answer_comments",
}
QUESTION_AVERAGES = {
    "average_question_score": "total_question_score",
    "average_question_body_length": "total_question_body_length",
    "average_answers_per_question": "total_question_answers",
    "average_accepted_answers_per_question": "total_question_accepted_answers",
    "average_question_comments": "total_question_comments",
}

MASTER_COLUMNS = (
    *USER_COLUMNS,
    "number_of_badges", "number_of_comments",
    "total_answer_score", "total_answer_views", "total_answer_comments",
    "total_answer_favourites", "total_answers",
    "average_answer_score", "average_answer_body_length", "average_answer_comments",
    "total_question_score", "total_question_views", "total_question_answers",
    "total_question_accepted_answers", "total_question_comments",
    "total_question_favourites", "total_questions",
    "average_question_score", "average_question_body_length",
    "average_answers_per_question", "average_accepted_answers_per_question",
    "average_question_comments",
)


FLAGS = ("has_website", "has_location", "has_about_me")


def _type(name: str) -> str:
    if name in FLAGS:
        return "int"
    return "double" if name.startswith("average") else "bigint"


def _ddl(columns) -> str:
    return ", ".join(f"{name} {_type(name)}" for name in columns)


# Schemas of the text sets.
SET_SCHEMAS = {
    "users": _ddl(USER_COLUMNS),
    "questions": _ddl(QUESTION_COLUMNS),
    "answers": _ddl(ANSWER_COLUMNS),
    "badges": _ddl(("user_id", "number_of_badges")),
    "comments": _ddl(("user_id", "number_of_comments")),
    "postlinks": _ddl(("post_id", "number_of_links")),
    "posthistory": _ddl(("user_id", "post_id", "number_of_edits")),
    "master": _ddl(MASTER_COLUMNS),
}
