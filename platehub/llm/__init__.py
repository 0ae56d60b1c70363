"""Training-data operators: quality, licences, mixing, chat, near duplicates,
host rules, decontamination, line dedup, URL filters, suffix arrays, periodic runs,
language ID and phrase mining."""
