"""DataFrame operators: text, vectors, linreg, logreg, mf, gradcheck."""
