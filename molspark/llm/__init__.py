"""Training-data operators: language ID, HTML text, secrets, near duplicates,
decontamination, URL rules, packing, LM scores, nearest neighbours, WARC."""
