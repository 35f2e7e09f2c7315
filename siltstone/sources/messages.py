"""Error messages made of the events' own columns: one per event, of many forms, with paths, lines and names in them."""

from __future__ import annotations

#: SQL that Spark and DuckDB read alike; [k] is the number in props. Forms follow one another by [k].
FORMS = [
    "concat('File \"/tmp/scene', user_id, '.py\", line ', event_id % 500, chr(10), 'NameError: name ''Obj', [k], ''' is not defined')",
    "concat('Traceback (most recent call last):', chr(10), 'ImportError: cannot import name ''part', [k], ''' from ''lib''')",
    "concat('AttributeError: ''Scene', user_id, ''' object has no attribute ''get_width''')",
    "concat('TypeError: method', [k], '() takes 2 positional arguments but ', event_id % 9, ' were given')",
    "concat('File \"a', user_id, '.py\", line ', [k], chr(10), 'SyntaxError: invalid syntax at ', event_id)",
    "concat('render timed out after ', [k], ' seconds')",
    "concat('MemoryError: ', event_id, ' bytes')",
    "concat('validation failed: ', event_type, ' of user ', user_id)",
    "concat('ModuleNotFoundError: No module named ''mod', [k], '''')",
    "concat('Animation Fade', [k], ' not found in ', event_type, chr(10), 'see \"/var/log/', user_id, '\"')",
    "concat('ValueError: color RED', [k], ' not defined here', repeat(' and so on', [k]))",
    "concat('KeyError: ', event_id)",
    "concat('NameError: name ''LIGHT_GRAY'' is not defined', repeat(chr(10), [k] % 3))",
    "''",
]
EXCEPTIONS = ["SyntaxError", "ImportError", "ModuleNotFoundError", "TimeoutError", "MemoryError", "OSError", "ValueError", "KeyError", "NameError"]


def message_sql(k: str) -> str:
    """The message of an event as a SQL expression; k: SQL for the number in props."""
    return (f"CASE [k] % {len(FORMS)} " + " ".join(f"WHEN {n} THEN {f}" for n, f in enumerate(FORMS)) + " END").replace("[k]", k)
