"""Column expressions and aggregate measures; no DataFrame logic lives here."""
