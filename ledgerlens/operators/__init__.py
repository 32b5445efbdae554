"""Table operators: each takes DataFrames and returns a lazy DataFrame unless its text says otherwise."""
