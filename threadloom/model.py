"""Table schemas. Absent and null are one thing; flags are only false when a false is stored."""

from pyspark.sql import types as T

URL = T.StructType([T.StructField("expanded_url", T.StringType())])

POST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("lang", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("screen_name", T.StringType())])),
        T.StructField(
            "entities",
            T.StructType(
                [
                    T.StructField("urls", T.ArrayType(URL)),
                    T.StructField("media", T.ArrayType(T.StructType([T.StructField("media_url", T.StringType())]))),
                ]
            ),
        ),
        T.StructField("in_reply_to_status_id", T.LongType()),
        T.StructField("in_reply_to_user_id", T.LongType()),
        T.StructField("retweeted_status", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("look_for_upstream", T.BooleanType()),
        T.StructField("possibly_hateful_comments", T.BooleanType()),
        T.StructField("checked", T.BooleanType()),
        T.StructField("interesting", T.BooleanType()),
        T.StructField("last_checked_for_errors", T.TimestampNTZType()),
    ]
)

COMMENT = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("hateful_value", T.DoubleType()),
    ]
)

RELEASE_FIELDS = ["tweet_id", "text", "slug", "title", "url", "user", "body", "created_at", "comments"]

# A release file as it is read: dates wrapped, one more column for records that do not parse.
RELEASE_FILE = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("created_at", T.StructType([T.StructField("$date", T.StringType())])),
        T.StructField("comments", T.ArrayType(COMMENT)),
        T.StructField("part", T.LongType()),
    ]
)

API_ERROR = T.StructType(
    [
        T.StructField("message", T.StringType()),
        T.StructField("api_code", T.IntegerType()),
        T.StructField("tweet_id", T.LongType()),
    ]
)

# A landed lookup: a payload or an error for each id asked for.
RESPONSE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("api_code", T.IntegerType()),
        T.StructField("message", T.StringType()),
    ]
)

PAGE = T.StructType([T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])

# The categories annotators vote on.
CATEGORIES = ["WOMEN", "LGBTI", "RACISM", "CLASS", "POLITICS", "DISABLED", "APPEARANCE", "CRIMINAL"]

ANNOTATION = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("article_id", T.LongType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(name, T.ArrayType(T.StringType())) for name in ["HATE", *CATEGORIES]],
    ]
)


def missing_fields(actual: T.StructType, declared: T.StructType, path: str = "") -> list[tuple[str, str]]:
    """Declared fields, nested ones included, that ``actual`` lacks or holds in another type."""
    have = {f.name: f.dataType for f in actual.fields}
    out = []
    for field in declared.fields:
        name = f"{path}{field.name}"
        found, wanted = have.get(field.name), field.dataType
        if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
            found, wanted, name = found.elementType, wanted.elementType, name + "[]"
        if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
            out += missing_fields(found, wanted, name + ".")
        elif found != wanted:
            out.append((name, wanted.simpleString()))
    return out


def schema_paths(schema: T.StructType, path: str = "") -> list[tuple[str, str]]:
    """Every field of a schema as ``(path, type)``, elements of arrays under ``[]``."""
    out = []
    for field in schema.fields:
        kind, name = field.dataType, f"{path}{field.name}"
        out.append((name, kind.simpleString()))
        if isinstance(kind, T.ArrayType):
            kind, name = kind.elementType, name + "[]"
        if isinstance(kind, T.StructType):
            out += schema_paths(kind, name + ".")
    return out
