"""Column names and types of the tables the library reads.

Schemas are explicit, so that ids are never read as numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The codes of a finished activity.
COMPLETE_STATUSES = ("4", "completed", "Complete")
# Fixed value: the code of a finished activity in the raw activity export.
EXPORT_COMPLETE_STATUS = ("4",)
# Fixed value: the item id of a staged record, which is no question.
STAGED_ITEM_ID = -1
# The transaction codes of a repeated purchase and the first date looked at.
REPEAT_PURCHASE_CODES = ("404", "405", "406")
REPEAT_PURCHASES_SINCE = "2019-01-01"


def _fields(*pairs: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in pairs])


RESPONSES = _fields(
    ("response_id", StringType()),
    ("student_id", StringType()),
    ("activity_id", LongType()),
    ("activity_id_hist", LongType()),
    ("enrollment_id", LongType()),
    ("source_system", StringType()),
    ("activity_status", StringType()),
    ("tutor_mode", StringType()),
    ("template_id", IntegerType()),
    ("template_name", StringType()),
    ("section_name", StringType()),
    ("item_section_position", IntegerType()),
    ("content_item_id", LongType()),
    ("content_item_name", StringType()),
    ("timestamp_created", TimestampNTZType()),
    ("timestamp_completed", TimestampNTZType()),
    ("milliseconds_used", LongType()),
    ("rawest_response", StringType()),
    ("raw_response", LongType()),
    ("scored_response", IntegerType()),
    ("is_scored", IntegerType()),
    ("correct_answer", LongType()),
)

# As exported, a response is text: a number or a letter.
RESPONSE_EXPORT = StructType(
    [StructField(f.name, StringType() if f.name == "raw_response" else f.dataType, True) for f in RESPONSES]
)

ACTIVITIES = _fields(
    ("student_id", StringType()),
    ("activity_id", LongType()),
    ("source_system", StringType()),
    ("activity_title", StringType()),
    ("activity_status", StringType()),
    ("template_id", IntegerType()),
    ("timestamp_created", TimestampNTZType()),
    ("timestamp_completed", TimestampNTZType()),
)

CONTENT_ITEMS = _fields(
    ("content_item_id", LongType()),
    ("content_item_name", StringType()),
    ("template_id", IntegerType()),
    ("section_name", StringType()),
    ("interaction_type_id", IntegerType()),
)

TEST_MAP = _fields(
    ("template_name", StringType()),
    ("num_ques", IntegerType()),
    ("response_threshold", DoubleType()),
    ("minutes_allowed", DoubleType()),
)

SECTION_MAP = _fields(
    ("section_name", StringType()),
    ("section_num_ques", IntegerType()),
    ("section_response_threshold", DoubleType()),
    ("min_items_per_seq", IntegerType()),
    ("minutes_allowed", DoubleType()),
    ("response_threshold", DoubleType()),
)

# Names in the source exports and the names used here.
RESPONSE_NAMES = {
    "item_status": "response_status",
    "sectionName": "section_name",
    "section_title": "section_name",
    "correctAnswer": "correct_answer",
}
ACTIVITY_NAMES = {"status": "activity_status"}
CONTENT_NAMES = {
    "question_number": "content_item_id",
    "product_name": "template_id",
    "exam_section_name": "section_name",
    "interactionTypeId": "interaction_type_id",
}
TEST_MAP_NAMES = {"numQues": "num_ques"}
SECTION_MAP_NAMES = {
    "sectionName": "section_name",
    "sectionResponseThreshold": "section_response_threshold",
    "min.items.per.seq": "min_items_per_seq",
}


def lower_first_letters(frame: DataFrame) -> DataFrame:
    """Lower-case the first letter of every header."""
    return frame.toDF(*[c[:1].lower() + c[1:] for c in frame.columns])


def canonical(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns of an export to the names used here; a column that has its name keeps it."""
    new_names = {old: new for old, new in names.items() if old in frame.columns and new not in frame.columns}
    return frame.withColumnsRenamed(new_names)
