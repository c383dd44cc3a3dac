"""Result encoding, the last-write-wins result table, typed re-reads and exports."""
