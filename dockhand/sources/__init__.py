"""Sources: table / query import, dated and windowed extracts, document
scans, filtered file sets and file inventories (S1-S10)."""
