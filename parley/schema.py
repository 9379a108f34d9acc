"""Table shapes shared by all operators."""

from pyspark.sql import types as T

# Column names of the message table.
DIALOG = "DialogID"
MESSAGE = "Message"
SENDER = "Sender"
DATE = "Date"
MINE = "Sent_by_me"
SEQ = "seq"
ELAPSED = "time_diff_seconds"
CONVERSATION = "ConversationID"

# Inside one dialog (Date, seq) is a total order: seq breaks ties between equal dates.
TIME_ORDER = (DATE, SEQ)
# Order in which an export lists the messages of a dialog.
SCAN_ORDER = (SEQ,)

# Text that stands for "there is no context".
NO_CONTEXT = "Time Gap"

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(DIALOG, T.StringType()),
        T.StructField(MESSAGE, T.StringType()),
        T.StructField(SENDER, T.StringType()),
        T.StructField(DATE, T.TimestampType()),
        T.StructField(MINE, T.BooleanType()),
        T.StructField(SEQ, T.LongType()),
    ]
)

QA_SCHEMA = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField(DIALOG, T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(MINE, T.BooleanType()),
        T.StructField(ELAPSED, T.LongType()),
        T.StructField(SEQ, T.LongType()),
    ]
)
