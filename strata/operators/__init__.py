"""Operators: terms (P1 P2 A1-A5 O1), postings (P3-P7 J1 A6 A7),
cluster (M1 M2 J2 A8-A12 I1-I6 O3 K2), timeuse (P8-P14 A13-A15 O2)."""
