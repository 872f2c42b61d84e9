"""A row-by-row interpreter of rule dictionaries, in plain Python.

LIKE follows SQL text by text; full-text rules are asked of an in-memory FTS5 table.
"""

import re
import sqlite3
import string

ASCII_UPPER = str.maketrans(string.ascii_lowercase, string.ascii_uppercase)


def like(value, pattern):
    expression = "".join({"%": "(?s:.*)", "_": "(?s:.)"}.get(c, re.escape(c)) for c in pattern)
    return re.fullmatch(expression, value) is not None


def like_pattern(match, term):
    shape = {"f": "{}", "p": "%{}%", "s": "{}%", "e": "%{}"}.get(match)
    return None if shape is None or term is None else shape.format(term).upper()


def fts_query(columns, search, term, separator="|"):
    where, what = search.split(separator), term.split(separator)
    parts = []
    for index, value in zip(where, what, strict=True):
        value = value.replace('"', "")
        parts.append(f"{columns[int(index)]}:" + (value if "(" in value else f'"({value})"'))
    return " ".join(parts)


def hits(table, columns, rules):
    """``table``: {id: [values]}; ``rules``: (rule_id, action, match, search, term, ...)."""
    con = sqlite3.connect(":memory:")
    con.execute(f"create virtual table t using fts5({','.join(columns)})")
    for key, values in table.items():
        con.execute(f"insert into t(rowid, {','.join(columns)}) values (?{',?' * len(columns)})", [key, *values])
    found = set()
    for rule_id, _, match, search, term, *_ in rules:
        if match is None or search is None:
            continue
        if match == "fts":
            try:
                query = fts_query(columns, search, term)
                found |= {(r[0], rule_id) for r in con.execute("select rowid from t where t match ?", (query,))}
            except (sqlite3.OperationalError, ValueError, IndexError, AttributeError):
                continue
            continue
        pattern = like_pattern(match, term)
        if pattern is None or not 0 <= int(search) < len(columns):
            continue
        for key, values in table.items():
            value = values[int(search)]
            if value is not None and like(value.translate(ASCII_UPPER), pattern):
                found.add((key, rule_id))
    return found


def labels(found, rules, n_labels, separator=", ", add_mode="tags"):
    """{id: None if deleted, else [labels]} by applying the rules one after another."""
    by_id = {}
    for key, rule_id in found:
        by_id.setdefault(key, set()).add(rule_id)
    result = {}
    for key, matched in by_id.items():
        mine = [r for r in sorted(rules) if r[0] in matched]
        if any(r[1] == "d" for r in mine):
            result[key] = None
            continue
        cells = [None] * n_labels
        for r in mine:
            if r[1] == "r":
                cells = [new if new is not None else old for new, old in zip(r[5:], cells)]
        for i in range(n_labels):
            tags = {r[5 + i] for r in mine if r[1] == "a" and r[5 + i]}
            if tags:
                if add_mode == "append" and cells[i] is not None:
                    tags |= set(cells[i].split(separator))
                cells[i] = separator.join(sorted(tags, key=str.encode))
        result[key] = cells
    return result
