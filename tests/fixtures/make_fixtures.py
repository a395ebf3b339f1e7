"""Writes the small, seeded CSV drop of the pipeline tests (run once; output committed).

Shipments and stock files of two regions; each faulty file has one fault.
"""

import csv
import os
import random

HERE = os.path.dirname(os.path.abspath(__file__))
SHIPMENT = ["part_no", "depot", "day", "boxes", "box_weight"]
STOCK = ["part_no", "depot", "day", "shelf", "on_hand", "minimum"]


def write(path, header, rows):
    full = os.path.join(HERE, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", encoding="utf-8", newline="") as fh:
        if header:
            out = csv.writer(fh, delimiter=";", lineterminator="\n")
            out.writerow(header)
            out.writerows(rows)


def shipments(rng, n):
    return [[f"K-{rng.randrange(15):03d}", rng.choice((3, 5, 8)), f"2030-{1 + k % 12:02d}-{1 + k % 27:02d}",
             rng.randrange(1, 60), round(rng.uniform(0.2, 30), 2)] for k in range(n)]


def stock(rng, n):
    return [[f"K-{k % 15:03d}", 3 + k % 2, f"2030-04-{1 + k % 27:02d}", f"S{k % 2}", rng.randrange(400), 25] for k in range(n)]


def main():
    rng = random.Random(77)
    labels = ("hinge", "bolt, long", 'plate 3"', "two\nlines", "spring; steel")
    write("static/parts.csv", ["part_no", "label", "maker"],
          [[f"K-{k:03d}", f" {labels[k % 5]}\t", ("Ost", "West")[k % 2]] for k in range(15)])
    write("input/north_shipments_good.csv", SHIPMENT, shipments(rng, 35))
    remarks = ["", 'said "urgent"', "line one\nline two", "a;b"]
    write("input/a/south_shipments_good.csv", SHIPMENT + ["remark"], [[*r, remarks[k % 4]] for k, r in enumerate(shipments(rng, 24))])
    write("input/b/south_shipments_good.csv", SHIPMENT[::-1], [r[::-1] for r in shipments(rng, 18)])  # same name, other order
    twice = shipments(rng, 12)
    write("input/north_shipments_twice.csv", SHIPMENT, twice + twice[:4])
    bad = shipments(rng, 20)
    bad[0][4] = bad[-1][4] = "heavy"
    write("input/north_shipments_text_weight.csv", SHIPMENT, bad)
    write("input/south_shipments_no_part.csv", SHIPMENT[1:], [r[1:] for r in shipments(rng, 10)])
    write("input/south_shipments_empty.csv", None, [])
    write("input/south_shipments_same_column.csv", ["part_no", "depot", "day", "boxes", "Boxes"], shipments(rng, 5))
    lost = shipments(rng, 10)
    lost[4][0] = "K-999"
    write("input/north_shipments_unknown_part.csv", SHIPMENT, lost)
    gaps = shipments(rng, 14)
    gaps[3][2] = "-"
    write("input/north_shipments_gap.csv", SHIPMENT, gaps)
    many = shipments(rng, 16)
    many[7][3] = 9000
    write("input/south_shipments_many_boxes.csv", SHIPMENT, many)
    write("input/shipments_no_region.csv", SHIPMENT, shipments(rng, 9))
    write("input/north_stock_good.csv", STOCK, stock(rng, 30))
    moved = stock(rng, 10)
    moved[2][1] = 4
    write("input/south_stock_moved_shelf.csv", STOCK, moved)
    write("input/south_stock_good.csv", STOCK, stock(rng, 12))


if __name__ == "__main__":
    main()
