"""Fixed table schemas and enumerations of the trace lake."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

TOOL_CALL = T.StructType(
    [T.StructField("id", S), T.StructField("name", S), T.StructField("input", S)]
)

TURNS = T.StructType(
    [
        T.StructField("session_id", S),
        T.StructField("turn_index", L),
        T.StructField("role", S),
        T.StructField("content", S),
        T.StructField("ts", S),
        T.StructField("tool_calls", T.ArrayType(TOOL_CALL)),
        T.StructField("tool_result_for", S),
    ]
)

REWARD_DIMS = ("outcome", "intent", "execution", "orchestration", "expression")

# Enumerations of the stored tables.
ROLES = ("user", "assistant", "system", "tool")
SANITIZATION_STATUS = ("pending", "layer1_only", "done", "flagged", "human_review")
REVIEW_STATUS = ("auto_approved", "pending", "approved", "rejected", "revoked")
PUBLISH_STATUS = ("private", "published", "unpublished")
CONSENT_MODES = ("always", "never", "ask", "prompt-on-start", "dry-run")
SEVERITIES = ("high", "medium", "low")

# Placeholders stored where a value is missing.
NO_USER = "(no user turn)"
NO_ASSISTANT = "(no assistant turn)"
NO_USER_BACKFILL = "(no user message)"
NO_ASSISTANT_BACKFILL = "(no assistant reply)"
THINKING_PREFIX = "💭 思考\n\n"
