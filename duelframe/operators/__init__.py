"""DataFrame transforms, made to be chained with DataFrame.transform."""
