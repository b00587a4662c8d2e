"""Column expressions: text normalisation, chat formatting, fitting, parsing, ROUGE-L."""
