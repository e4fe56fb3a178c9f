"""Row layouts. Every field is text, as posts arrive as JSON with text values."""

from pyspark.sql.types import StringType, StructField, StructType


def text_fields(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


POST = text_fields("Id", "Title", "Body", "OwnerUserId", "CreationDate", "ClosedDate", "Score")
TAGGED_POST = text_fields(*POST.names, "tags")
IDENTIFIED_POST = text_fields(*TAGGED_POST.names, "message")
STORED_POST = text_fields(*POST.names, "tag")
TAG = text_fields("Id", "Tag")
LABEL = text_fields("Tag")
SUBMISSION = text_fields("posts", "id", "userid")

CORRUPT = "_corrupt_record"
