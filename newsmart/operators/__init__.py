"""DataFrame -> DataFrame operators: bronze (dedup), silver (clean, merge), gold
(counts, dimensions, fact), keys (dense surrogate ids), analysis (counts, ranks,
profile), keywords (word and keyword statistics), search (re-aimed API filters) and
windows (batch windows, landing completeness)."""
