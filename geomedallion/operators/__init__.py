"""DataFrame -> DataFrame operators.

nearest   grid-bin join (J2/J3) and nearest location per observation (W1/W2/T1)
joins     skew-safe salted left join
location  location dimension (J1) and location fact (J4)
dedup     keyed de-duplication (A3), first row per key, distinct (A4)
merge     keyed upsert (M1/M2/M3)
extract   watermark extraction (S6/P9/J5/A2) and run log (X4)
calendar  date bounds, series and dimension (A1, F15-F21)
quality   data-quality checks (A5-A9)
sizing    bounded size probes guarding broadcasts
"""
