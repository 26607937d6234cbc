"""The vocabulary of the log format and its rows in Spark."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the file format, in the order of their codes --------------------------------------

#: Plan nodes, from code 1.
NODES = (
    "Result", "ProjectSet", "ModifyTable", "Append", "Merge Append", "Recursive Union", "BitmapAnd", "BitmapOr", "Seq Scan", "Sample Scan",
    "Index Scan", "Index Only Scan", "Bitmap Index Scan", "Bitmap Heap Scan", "Tid Scan", "Tid Range Scan", "Subquery Scan", "Function Scan",
    "Values Scan", "Table Function Scan", "CTE Scan", "Named Tuplestore Scan", "WorkTable Scan", "Foreign Scan", "Custom Scan", "Nested Loop",
    "Merge Join", "Hash Join", "Materialize", "Memoize", "Sort", "Incremental Sort", "Group", "Aggregate", "WindowAgg", "Unique", "Gather",
    "Gather Merge", "Hash", "SetOp", "LockRows", "Limit",
)
#: Before version 14 nodes have the server's tags, which run from 331 and leave out 357.
OLD_TAG, OLD_GAP = 331, 357

#: Details, from code 1.
DETAILS = (
    "Output", "Filter", "Index Cond", "Order By", "Recheck Cond", "TID Cond", "Join Filter", "Hash Cond", "Merge Cond", "Sort Key", "Presorted Key",
    "Group Key", "Hash Key", "Function Call", "Table Function Call", "One-Time Filter", "Run Condition", "Heap Fetches", "Workers Planned",
    "Workers Launched", "Rows Removed by Filter", "Rows Removed by Join Filter", "Rows Removed by Index Recheck", "Inner Unique", "Sort Info",
    "Incremental Sort Groups", "Hash Info", "Storage Info", "Cache Key", "Cache Mode", "Memoize Stats", "Planned Partitions", "HashAgg Stats",
    "Index Searches", "Heap Blocks", "Subplans Removed", "Conflict Resolution", "Conflict Arbiter Index", "Conflict Filter",
    "Rows Removed by Conflict Filter", "Conflict Tuples", "Merge Tuples", "Trigger", "JIT", "Extension Explain", "Merge Actions", "Planning",
    "Custom Plan Provider", "Single Copy", "Alias", "Function Name", "Table Function Name", "CTE Name", "Tuplestore Name", "Sampling Method",
    "Sampling Parameters", "Repeatable Seed", "Schema", "Window", "Subplan Name",
)
#: Details that belong to one execution.
DYNAMIC_DETAILS = (18, 20, 21, 22, 23, 25, 26, 27, 28, 31, 33, 34, 35, 40, 41, 42, 45)
DETAIL_TYPES = ("string", "list", "double", "int", "uint", "bool")  # from code 1

RELATIONSHIPS = (None, "Outer", "Inner", "Member", "Subquery", "InitPlan", "SubPlan", "Custom")
COMPRESSIONS = ("none", "lz4", "zstd")
PROFILES = ("simple", "full")
MODES = ("none", "define", "ref")
NODE_FLAGS = {"parallel_aware": 1, "async_capable": 2, "has_actual": 4, "never_executed": 8, "has_buffers": 16, "has_wal": 32, "disabled": 64}
EXTRAS = {"modify": 1, "foreign": 2, "join": 3, "agg": 4, "setop": 5, "direction": 6}
OPERATIONS = (None, "Select", "Update", "Insert", "Delete", "Merge")
JOINS = ("Inner", "Left", "Full", "Right", "Semi", "Anti", "Right Semi", "Right Anti")
STRATEGIES = (("Aggregate", "Plain"), ("GroupAggregate", "Sorted"), ("HashAggregate", "Hashed"), ("MixedAggregate", "Mixed"))
SETOPS = (("SetOp", "Sorted"), ("HashSetOp", "Hashed"))
SET_COMMANDS = ("Intersect", "Intersect All", "Except", "Except All")
DIRECTIONS = {-1: "Backward", 0: "NoMovement", 1: "Forward"}
BUFFERS = (
    "Shared Hit Blocks", "Shared Read Blocks", "Shared Dirtied Blocks", "Shared Written Blocks", "Local Hit Blocks", "Local Read Blocks",
    "Local Dirtied Blocks", "Local Written Blocks", "Temp Read Blocks", "Temp Written Blocks", "Shared Read Time", "Shared Write Time",
    "Local Read Time", "Local Write Time", "Temp Read Time", "Temp Write Time",
)
BUFFER_COUNTS = 10  # the rest are times in microseconds
WAL = ("WAL Records", "WAL FPI", "WAL Bytes", "WAL Buffers Full")
CONTEXT = ("pid", "backend_type_id", "backend_type", "database_oid", "database", "user_oid", "auth_user", "user", "app", "client_host", "client_port")

FILE_MAGIC, RECORD_MAGIC, PAYLOAD_MAGIC = 0x315A4541, 0x325A4541, 0x335A4541
VERSION, HEADER_BYTES = 14, 40
#: Microseconds from the Unix epoch to that of the format's times, 2000-01-01.
EPOCH_US = 946_684_800_000_000

# Rows ----------------------------------------------------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()
DETAIL = _struct(code=I, label=S, type=S, s=S, sl=T.ArrayType(S), d=D, i=L, b=B)
NODE = _struct(
    node_path=T.ArrayType(I), depth=I, relationship=S, node_code=I, node_type=S, node_flags=I, extra_kind=I, extra1=L, extra2=L, startup_cost=D, total_cost=D, plan_rows=D,
    plan_width=L, startup_us=L, total_us=L, rows=D, loops=D, never_executed=B, buffers=T.ArrayType(L), wal=T.ArrayType(L), relation_oid=L, relation=S, alias=S, schema=S,
    index_oid=L, index=S, details=T.ArrayType(DETAIL),
)
CTX = T.StructType([T.StructField(c, L if c in ("pid", "backend_type_id", "database_oid", "user_oid") else S) for c in CONTEXT])
TEMPLATE = _struct(mode=S, id=L, shape_hash=L, metrics=S)
LOG_FILE = _struct(path=S, format_version=I, compression=S, file_flags=I, server_version=L, server_start=T.TimestampType(), server_start_epoch=L, pid=L)
LOG_RECORD = _struct(
    file=LOG_FILE, offset=L, record_no=L, ts=T.TimestampType(), duration_us=L, profile=S, flags=I, query_id=L, plan_id=L, ctx=CTX, template=TEMPLATE,
    query_text=S, params=S, details=T.ArrayType(DETAIL), nodes=T.ArrayType(NODE),
)
