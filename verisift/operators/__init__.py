"""Check operators: profile (P1-P4), row rules (R1-R5), joins (J1-J6),
query contracts (Q1-Q3) and roll-ups (A2-A6)."""
