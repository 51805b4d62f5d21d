"""Error-log enrichment as column expressions: remedy text and category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.parse import col_

# fixed values: remedy suggestion per error type
SUGGESTIONS = {
    "FileNotFoundError": "检查文件路径是否正确并存在（确认文件名和目录）。",
    "PermissionError": "检查该文件/目录的读写权限或是否被其他进程锁定。",
    "MemoryError": "数据量可能过大，考虑增加内存/使用流式处理或减小 chunk 大小。",
    "ValueError": "数据格式错误或类型不匹配，请检查字段值及格式。",
    "KeyError": "缺少预期列，检查源表头是否包含必要字段。",
    "UnicodeDecodeError": "文件编码不匹配，尝试以 UTF-8/GBK 打开或检查文件来源。",
    "OSError": "操作系统级错误，请检查路径、权限和磁盘空间。",
    "TimeoutError": "操作超时，重试或增大超时设置。",
    "InvalidFileException": "Excel文件可能已损坏或格式不正确，请检查文件是否可以正常打开。",
    "InvalidFileFormatException": "Excel文件格式不正确或已损坏，请验证文件完整性。",
    "FileLockedException": "文件被其他程序锁定，请关闭Excel应用程序或其他可能使用该文件的程序。",
}

# fixed values: message keywords (lower-case) -> error type whose remedy applies
MESSAGE_KEYWORDS = [
    (("permission",), "PermissionError"),
    (("not found",), "FileNotFoundError"),
    (("invalid file", "corrupt"), "InvalidFileException"),
    (("lock", "access denied"), "FileLockedException"),
]


def error_suggestion(error_type, message=None) -> Column:
    """Remedy text: by error type, else by keywords in the message, else ''."""
    t = col_(error_type).cast("string")
    lookup = F.create_map(*[F.lit(x) for kv in SUGGESTIONS.items() for x in kv])
    by_type = F.try_element_at(lookup, t)
    result = by_type
    if message is not None:
        msg = F.lower(col_(message).cast("string"))
        chain = None
        for words, target in MESSAGE_KEYWORDS:
            cond = None
            for w in words:
                c = msg.contains(w)
                cond = c if cond is None else (cond | c)
            chain = (F.when(cond, F.lit(SUGGESTIONS[target])) if chain is None
                     else chain.when(cond, F.lit(SUGGESTIONS[target])))
        result = F.coalesce(by_type, chain)
    return F.when(t.isNull() | (t == ""), F.lit("")).otherwise(F.coalesce(result, F.lit("")))


def error_category(error_type, message) -> Column:
    """Category of an error row from its exception type name and message."""
    t = col_(error_type).cast("string")
    msg = F.lower(F.coalesce(col_(message).cast("string"), F.lit("")))
    return (F.when(t == "FileNotFoundError", "FILE_NOT_FOUND")
            .when(t == "PermissionError", "PERMISSION")
            .when(t == "MemoryError", "MEMORY_ERROR")
            .when(msg.contains("xlsx") | msg.contains("openpyxl"), "EXCEL_PARSE")
            .when(msg.contains("database") | msg.contains("sql"), "DB_QUERY")
            .otherwise("UNKNOWN"))

