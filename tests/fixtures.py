"""A small order and customer lake, made by rule, with the quirks the operators have to cope with.

Headers with blanks, a quoted comma, empty and unreadable totals, customers without orders, records
with nested structs and arrays (some empty), a column that holds numbers in some records and text in
others, codes with leading zeros, non-ASCII names.
"""

import csv
import json
from pathlib import Path

HEADER = ["cust id", "order total", "order date", "status"]
STATUSES = ["shipped", "delivered", "cancelled", "pending", "refunded", "shipped"]
CITIES = ["Ålesund", "Brno", "Łódź", "Porto", "Graz"]


def orders(count: int = 60, first_day: int = 1, step: int = 7) -> list[list[str]]:
    rows = []
    for i in range(count):
        customer = f"K{i * step % 9 + 1:03d}"
        total = "" if i % 23 == 11 else f"{i * 37 % 400 + i % 4 * 0.25:.2f}"
        status = "shipped, partial" if i % 29 == 10 else STATUSES[i * 5 % 6 if i % 2 else i % 6]
        rows.append([customer, total, f"2026-03-{first_day + i * 5 % 11:02d}", status])
    return rows


def orders_bad() -> list[list[str]]:
    rows = orders(12)
    rows[4] = [rows[4][0], "n/a", rows[4][2], "shipped"]
    rows[7] = [rows[7][0], "12d", rows[7][2], "delivered"]
    return rows


def customers() -> list[dict]:
    points = [1200, "gold", 800, 0, "platinum", 45, "17", 12.5, None, 3, 99]
    out = []
    for i, value in enumerate(points):
        kinds = [["email", "phone"], ["email"], []][i % 3]
        record = {
            "customer_id": f"K{i + 1:03d}",
            "name": f"Name {i}",
            "address": {"city": CITIES[i % 5], "zip": f"{i * 977:05d}"},
            "contacts": [{"type": kind, "value": f"{kind}-{i}"} for kind in kinds],
            "loyalty_points": value,
        }
        out.append(record)
    return out


def log_lines() -> list[str]:
    levels = ["INFO", "WARN", "INFO", "ERROR"]
    lines = [
        f"2026-03-01T08:{i:02d}:22Z {levels[i % 4]} shop-{i % 2} cust=K{i:03d} status=ok amount={i}.5{i}"
        for i in range(9)
    ]
    return [*lines, "no log line at all", "2026-03-01T08:00:22Z INFO a b cust=K1 status=ok amount=1"]


def _csv(path: Path, rows: list[list[str]]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n").writerows([HEADER, *rows])


def write_orders(folder: str, name: str, rows: list[list[str]]) -> None:
    _csv(Path(folder) / name, rows)


def write_all(root: Path) -> dict[str, str]:
    paths = {name: str(root / "files" / name) for name in ("orders", "orders_bad", "customers", "serverlog")}
    write_orders(paths["orders"], "orders.csv", orders())
    write_orders(paths["orders_bad"], "orders_bad.csv", orders_bad())
    for name, lines in (
        ("customers", [json.dumps(c, ensure_ascii=False) for c in customers()]),
        ("serverlog", log_lines()),
    ):
        folder = Path(paths[name])
        folder.mkdir(parents=True)
        (folder / f"{name}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return paths
