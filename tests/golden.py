"""Published result tables at two decimals, and what follows from them."""

# Mean and median per period.
SUMMARY = [
    ("2º estado de alarma", 356.06, 155.0),
    ("Confinamiento", 173.86, 73.0),
    ("Desescalada", 321.15, 148.0),
    ("Post-restricciones", 360.09, 171.0),
    ("Pre-COVID", 425.75, 199.0),
]

# Percent change against the baseline period.
BASELINE_CHANGE = {
    "2º estado de alarma": -16.37,
    "Confinamiento": -59.16,
    "Desescalada": -24.57,
    "Post-restricciones": -15.42,
    "Pre-COVID": 0.0,
}

# Year, annual mean, percent change against the year before, label of the change.
ANNUAL = [
    (2019, 424.973000, None, None),
    (2020, 312.219167, -26.53, "-26.5%"),
    (2021, 362.009167, 15.95, "+15.9%"),
    (2022, 349.768333, -3.38, "-3.4%"),
]

# Monthly means; month, then one column per year 2019 to 2022.
MONTH_YEAR = """
1      -   423.99 290.82 337.54
2      -   446.83 358.11 345.31
3   448.98 253.69 373.50 324.52
4   428.27 112.41 374.47 329.53
5   442.28 179.46 377.39 358.50
6   449.72 312.10 394.85 360.60
7   416.32 329.68 349.90 319.86
8   311.28 253.29 270.98 257.62
9   436.53 354.16 388.18 383.41
10  457.63 350.51 391.34 432.49
11  443.71 359.85 403.76 381.81
12  415.01 370.66 370.81 366.03
"""

# Hourly means; hour, then one column per period in time order.
HOUR_PERIOD = """
0  205.51  61.66 142.46 101.46 180.01
1  141.44  41.80  93.45  47.28 123.13
2   98.43  31.38  60.56  32.87  87.52
3   77.46  25.86  43.35  29.76  72.58
4   69.02  24.49  38.15  31.76  66.66
5   83.37  34.63  50.60  49.04  78.59
6  196.58 107.86 144.03 146.68 166.00
7  424.04 207.21 304.78 317.00 332.80
8  565.55 239.98 426.63 468.78 466.37
9  573.66 234.61 442.25 496.12 483.29
10 526.09 231.77 414.31 453.88 447.93
11 543.74 241.69 436.59 486.05 471.86
12 576.42 255.45 466.17 525.80 500.23
13 604.53 271.68 489.13 559.44 525.49
14 653.99 314.27 532.85 606.83 565.08
15 594.83 283.26 470.32 535.23 509.34
16 557.97 204.77 400.01 484.59 465.83
17 602.15 200.62 424.34 523.71 503.34
18 642.11 220.91 462.80 549.91 532.49
19 639.39 214.95 467.63 538.57 532.65
20 599.83 201.67 443.86 481.96 499.24
21 519.04 180.17 383.88 390.92 420.47
22 378.42 143.43 280.14 279.23 307.84
23 266.09  94.92 194.06 198.19 226.45
"""


def matrix(text: str) -> dict[int, list[float | None]]:
    rows = [line.split() for line in text.strip().splitlines()]
    return {int(r[0]): [None if x == "-" else float(x) for x in r[1:]] for r in rows}
