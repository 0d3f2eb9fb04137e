"""A plain ordered replay of the log, for comparison with the operators."""

DDL = ("CREATE", "ALTER", "DROP", "TRUNCATE", "RENAME")
ALL = ("BEGIN", "COMMIT", "ROLLBACK", *DDL)


def statement_class(query):
    for name in ALL:
        if query.upper().startswith(name):
            return name
    return "QUERY"


def replay(entries):
    """Yield (in_txn before, number of the transaction or None, latest db before) per entry."""
    number, current, in_txn, db = 0, None, False, None
    for e in entries:
        before, db_before, got = in_txn, db, None
        if e["kind"] == "QUERY":
            cls = statement_class(e["query"])
            if cls == "BEGIN":
                number += 1
                current, in_txn, got = number, True, number
            elif not in_txn:
                number += 1
                got = number
            else:
                got = current
            if cls in ("COMMIT", "ROLLBACK"):
                in_txn, current = False, None
        elif e["kind"] == "XID":
            got = current if in_txn else None
            in_txn, current = False, None
        elif e["kind"] in ("TABLE_MAP", "INSERT", "UPDATE", "DELETE"):
            db = e["db"]
            if e["captured"]:
                if not in_txn:
                    number += 1
                    current, in_txn = number, True
                got = current
        yield before, got, db_before
