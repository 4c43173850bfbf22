"""Silver and gold transforms and the runs that apply them."""
