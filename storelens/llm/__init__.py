"""Training-data operators: quality, chat, licences, rules, packing, HTML, language, decontamination, tokens, near copies."""
