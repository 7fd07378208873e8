"""Hand-made landing files."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

from test_rules import GOOD

T0 = datetime(2024, 1, 4)


def inspection(unit, when, machine="m1", supplier="s1", **changes):
    row = {**GOOD, "unit_id": unit, "timestamp": str(when), "machine_id": machine, "supplier_id": supplier}
    return {**row, **changes}


def label(unit, value, when):
    return {"unit_id": unit, "is_defective": value, "label_available_date": str(when)}


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def write_catalogs(landing):
    tables = {
        "machines": "machine_id,machine_type,line_id,installation_date,vibration_baseline_mm_s\n"
        "m1,press,LINE_A,2020-01-01,1.5\nm2,oven,LINE_B,2024-01-01,2.5\n",
        "lines": "line_id,daily_capacity,clean_room_class\nLINE_A,100,ISO5\nLINE_B,200,ISO6\n",
        "suppliers": "supplier_id,start_date,expected_quality,solder_thickness_mean_um\n"
        "s1,2019-01-01,0.99,100\ns2,2024-02-01,0.9,120\n",
        "operators": "operator_id,experience_level,shift\no1,senior,morning\n",
        "maintenance": "maintenance_id,machine_id,maintenance_date,maintenance_type\n"
        "a,m1,2024-01-02 08:00:00,full\nb,m1,2023-01-01 00:00:00,full\nc,m1,2025-01-01 00:00:00,full\n",
    }
    for name, text in tables.items():
        os.makedirs(f"{landing}/{name}", exist_ok=True)
        with open(f"{landing}/{name}/{name}.csv", "w") as out:
            out.write(text)


def write_landing(landing):
    """72 good inspections over three days and two machines, five bad records, labels for some."""
    write_catalogs(landing)
    rows, labels = [], []
    for i in range(72):
        when = T0 + timedelta(hours=i)
        rows.append(inspection(f"u{i}", when, f"m{1 + i % 2}", f"s{1 + i % 2}", voltage_v=3.0 + (i % 10) / 10))
        if i % 3:
            labels.append(label(f"u{i}", int(i % 4 == 1), when + timedelta(hours=i % 50)))
    bad = [
        inspection("b1", T0, voltage_v=99.0),
        inspection("b2", T0, voltage_v=None),
        inspection("b3", "no time"),
        '{"unit_id": "b4", "timestamp": "2024-01-05 00:00:00", "machine_id": "m1", "voltage_v": "high"}',
        "{broken",
    ]
    write_lines(f"{landing}/inspections/history/2024/01/a.json", rows[:40] + bad)
    write_lines(f"{landing}/inspections/production/2024/01/b.json", rows[40:])
    labels += [label("u1", 1, T0 + timedelta(days=29)), label("u2", 7, T0), label("zzz", 1, T0)]
    write_lines(f"{landing}/labels/history/2024/01/a.json", labels[:20])
    write_lines(f"{landing}/labels/production/2024/01/b.json", labels[20:])
    return rows, labels


def write_flush(landing):
    """Rows far in the future on both sides: they push the watermarks past everything else."""
    late = T0 + timedelta(days=400)
    write_lines(f"{landing}/inspections/production/2025/02/z.json", [inspection("flush", late, "flush")])
    write_lines(f"{landing}/labels/production/2025/02/z.json", [label("flush", 0, late)])
